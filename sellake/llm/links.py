"""Links between sets that share keys: shared by the operators on word shingles.

Given postings (key, id), two sets are candidates when they share a key. All components of linked sets are found without the pairs
of a group, and each link that is used is decided on the full sets:

1. In each round every key proposes its sets with one pivot, the set of least hash in that round. A round makes no more rows than there are postings.
   Between rounds ids get labels of connected ids (one step of ``components``); before the blocks the components so far are found whole.
   Keys whose sets are in one component by then are done.
2. What is left after ``ROUNDS`` is compared in blocks of bounded size. In a key, only sets outside its largest component are
   held against the others, so a big group of copies with a few strangers costs rows in proportion to its size, not to its square.
3. A proposed pair must pass a test of short signatures. Then the sets themselves meet: pairs are laid out by the file that
   holds the set, so each task reads its own file of sets beside its own part of the pairs, and a set is shuffled once a
   pair that needs it, never once more to find its pairs. A pivot of many pairs is dealt to several tasks.

Joins that grow with the input are merge joins at every size; nothing here is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SideTable, cut, runs

#: Rounds with pivots; members that meet a pivot in one task, about; entries of a block, about.
ROUNDS, CHUNK, BLOCK = 2, 1024, 1000
#: Least bytes of a parity bitmap, and those of a folded one.
SIG_BYTES = 128
#: Bits of a row number that count rows of one file of sets; the bits above are the file's own number, its home.
HOME_BITS = 36


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct 56-bit hashes of the word ``size``-grams; of fewer words, one hash of them all; of none, nothing."""
    import xxhash

    words = text.lower().split()  # of bytes: A-Z only, and the white space \x20 \x09-\x0D
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    k = min(size, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(words) - k + 1 + i])
    return np.unique(out >> np.uint64(8))


def packed(g: np.ndarray) -> bytes:
    """A sorted set as the bytes of its gaps, like ones together, compressed."""
    import zstandard

    planes = np.diff(g, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T[:7]
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(column) -> Iterator[np.ndarray]:
    """The sets of an Arrow column of packed ones."""
    import zstandard

    unpack = zstandard.ZstdDecompressor()
    for raw in column:
        planes = np.frombuffer(unpack.decompress(raw.as_py()), np.uint8).reshape(7, -1)
        out = np.zeros((planes.shape[1], 8), np.uint8)
        out[:, :7] = planes.T
        yield np.cumsum(out.reshape(-1).view("<u8"), dtype=np.uint64)


#: Whether pairs may link: signatures of either side (lists of bytes) and sizes of either side (arrays) -> array of booleans.
Test = Callable[[list, list, np.ndarray, np.ndarray], np.ndarray]


def parity(g: np.ndarray) -> bytes:
    """Bit p is set where an odd number of members fall on it. Two bits a member, SIG_BYTES at least and 8 kB at most: of two
    bitmaps the longer folds onto the shorter."""
    m = 8 * SIG_BYTES
    while m < min(2 * len(g), 1 << 16):
        m *= 2
    return np.packbits(np.bincount((g >> np.uint64(20)).astype(np.int64) % m, minlength=m).astype(np.uint8) & 1).tobytes()


def _fold(sig: bytes, size: int) -> np.ndarray:
    x = np.frombuffer(sig, np.uint8)
    return np.bitwise_xor.reduce(x.reshape(-1, size), axis=0) if len(x) > size else x


def folded(sig: bytes) -> bytes:
    """A bitmap of SIG_BYTES."""
    return _fold(sig, SIG_BYTES).tobytes()


def may_link(percent: int) -> Test:
    """Whether the bits that differ, never more than the members that do, leave the wanted likeness possible."""

    def bits(x: bytes, y: bytes) -> int:
        size = min(len(x), len(y))
        return int(np.bitwise_count(_fold(x, size) ^ _fold(y, size)).sum())

    return lambda sa, sb, na, nb: np.fromiter((bits(x, y) * (100 + percent) <= (100 - percent) * t for x, y, t in zip(sa, sb, (na + nb).tolist())), bool, len(sa))


def may_differ(percent: int):
    """The same for rows of folded bitmaps against one."""
    return lambda sigs, sig, n, own: np.bitwise_count(sigs ^ sig).sum(axis=1, dtype=np.int64) * (100 + percent) <= (100 - percent) * (n + own)


def write_sets(docs: DataFrame, size: int, extra: Callable[[np.ndarray], dict], extra_types: dict[str, pa.DataType], extra_schema: str) -> DataFrame:
    """A written row per row (doc, text, ...) of ``docs``: row (its number), doc, n, digest of the set, what ``extra`` makes of
    the set, grams (the packed set), and the further columns of ``docs``. Row numbers rise within a file."""
    more = docs.columns[2:]
    types = {"row": pa.int64(), "doc": pa.int64(), "n": pa.int64(), "digest": pa.binary(), "grams": pa.binary()} | extra_types

    def make(batches):
        import xxhash

        row = TaskContext.get().partitionId() << HOME_BITS
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part, out = b.slice(i, 256), {c: [] for c in types}
                for doc, t in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary())):
                    g = gram_set(t.as_py() or b"", size)
                    for c, v in ({"row": row, "doc": doc, "n": len(g), "digest": xxhash.xxh3_128_digest(g.tobytes()), "grams": packed(g)} | extra(g)).items():
                        out[c].append(v)
                    row += 1
                yield pa.RecordBatch.from_arrays([*(pa.array(out[c], t) for c, t in types.items()), *part.columns[2:]], names=[*types, *more])
            pa.default_memory_pool().release_unused()

    further = "".join(f", {f.name} {f.dataType.simpleString()}" for f in docs.schema[2:])
    return cut(docs.mapInArrow(make, "row long, doc long, n long, digest binary, grams binary" + extra_schema + further), "sets")


def components(edges: DataFrame, steps: int | None = None) -> DataFrame:
    """(id, label): the least id of each component, for ids with an edge (a, b). Every node takes the least label among its
    neighbours until nothing changes; from the third step on also its label's label, so that long chains end in few steps. Each step
    is written, so lineage stays short. After ``steps`` steps it stops: ids of one label are then connected, but a component may have several."""
    both = cut(edges.select("a", "b").union(edges.select("b", "a")), "edges")
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    done = 0
    while done != steps:
        near = both.hint("merge").join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        step = labels.hint("merge").join(near, "id").select("id", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        if done >= 2:
            up = labels.where("id <> label").select(F.col("id").alias("label"), F.col("label").alias("up"))
            step = step.hint("merge").join(up, "label", "left").select("id", F.least("label", "up").alias("label"), "was")
        new, done = cut(step, "labels"), done + 1
        labels = new.drop("was")
        if done != steps and not new.where("label <> was").limit(1).count():
            break
    return labels


class Links:
    """Links of ``sets`` (columns row, n, sig, grams): 100 * intersection >= percent * union.

    ``may`` tests signatures; ``fold`` makes signatures of one length for the blocks, and ``may_fold`` tests rows of them against one.
    ``fragment_of`` gives the fragment (0 to ``fragments`` - 1) of each member of a set; overlaps are counted by fragment and summed.
    """

    def __init__(self, sets: DataFrame, percent: int, may: Test, fold: Callable[[bytes], bytes], may_fold: Callable, fragment_of: Callable = lambda g: np.zeros(len(g), int), fragments: int = 1):
        self.sets, self.percent, self.may, self.fold, self.may_fold, self.fragment_of, self.fragments = sets, percent, may, fold, may_fold, fragment_of, fragments

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b, parts) that the signatures don't rule out, written."""
        may = self.may

        def test(batches):
            for b in batches:
                ok = may(b.column("sa").to_pylist(), b.column("sb").to_pylist(), b.column("na").to_numpy(), b.column("nb").to_numpy())
                yield b.select(["a", "b", "parts"]).filter(pa.array(ok, pa.bool_()))

        pairs = pairs.groupBy("a", "b").agg(F.max("parts").alias("parts"))
        side = lambda x: self.sets.select(F.col("row").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}"))
        met = pairs.hint("merge").join(side("a"), "a").hint("merge").join(side("b"), "b")
        return cut(met.mapInArrow(test, "a long, b long, parts int"), "pairs")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link, decided on the full sets: a task gets a fragment of a pivot ``a`` and then those of its ``b``."""
        home = lambda c: F.shiftright(c, HOME_BITS).alias("home")
        slot = (F.col("parts") + F.pmod(F.xxhash64("b"), F.col("parts"))).cast("int")
        members = pairs.select(home("b"), F.col("b").alias("id"), F.col("a").alias("to"), slot.alias("slot"), F.lit(1).alias("member"))
        pivots = members.select(home("to"), F.col("to").alias("id"), "to", "slot", F.lit(0).alias("member")).distinct()
        side, split, fragments, percent = SideTable(members.union(pivots), "home", "id", "pairs-by-home"), self.fragment_of, self.fragments, self.percent

        def send(batches):
            cursor = side.cursor()
            for b in batches:
                for i in range(0, b.num_rows, 512):
                    part = b.slice(i, 512)
                    rows = part.column("row").to_numpy()
                    for run in runs(rows >> HOME_BITS):
                        entries = cursor.take(int(rows[run.start]) >> HOME_BITS, rows[run])
                        if entries is None:
                            continue
                        at = np.searchsorted(rows[run], entries.column("id").to_numpy())
                        needed = np.unique(at)
                        own = part.slice(run.start, run.stop - run.start).take(pa.array(needed))
                        pieces = []
                        for g in unpacked(own.column("grams")):
                            f = split(g)
                            pieces.append([(k, packed(g[f == k])) for k in range(fragments) if (f == k).any()])
                        place = np.searchsorted(needed, at)
                        n = own.column("n").to_numpy()[place]
                        whose, frag, data = [], [], []
                        for e, p in enumerate(place.tolist()):
                            for k, raw in pieces[p]:
                                whose.append(e), frag.append(k), data.append(raw)
                        out = entries.take(pa.array(whose, pa.int64()))
                        yield pa.RecordBatch.from_arrays([*(out.column(c).combine_chunks() for c in ("to", "slot", "member", "id")), pa.array(n[whose] if whose else [], pa.int64()), pa.array(frag, pa.int32()), pa.array(data, pa.binary())],
                                                         names=["to", "slot", "member", "id", "n", "fragment", "grams"])

        def meet(batches):
            held, key, size = None, None, 0
            for b in batches:
                out = [[], [], [], [], []]
                for to, slot, fragment, member, i, n, g in zip(*(b.column(c).to_numpy().tolist() for c in ("to", "slot", "fragment", "member", "id", "n")), unpacked(b.column("grams"))):
                    if not member:
                        key, held, size = (to, slot, fragment), g, n
                    elif key == (to, slot, fragment):
                        at = np.searchsorted(held, g)
                        both = int((held[np.minimum(at, len(held) - 1)] == g).sum())
                        if both:
                            for c, v in zip(out, (to, i, size, n, both)):
                                c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["a", "b", "na", "nb", "both"])

        sent = self.sets.select("row", "n", "grams").mapInArrow(send, "to long, slot int, member int, id long, n long, fragment int, grams binary")
        dealt = sent.repartition("to", "slot", "fragment").sortWithinPartitions("to", "slot", "fragment", "member")
        met = dealt.mapInArrow(meet, "a long, b long, na long, nb long, both long")
        if fragments > 1:
            met = met.groupBy("a", "b", "na", "nb").agg(F.sum("both").alias("both"))
        return met.where(F.col("both") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")

    def near(self) -> Column:
        """Whether the sizes n and pn leave the wanted likeness possible."""
        return F.least("n", "pn") * 100 >= F.greatest("n", "pn") * self.percent

    def blocks(self, postings: DataFrame) -> DataFrame:
        """All pairs (a, b, parts) of different labels in ``postings`` (gram, id, n, label) that folded signatures don't rule
        out. In a gram, sets outside its largest label ("strangers") are dealt to blocks with all sets."""
        sizes = postings.groupBy("gram", "label").agg(F.count("*").alias("k"))
        of = cut(sizes.groupBy("gram").agg(F.sum("k").alias("e"), F.max(F.struct("k", "label")).alias("top")).where("top.k < e"), "block-keys")
        rows = postings.select("gram", "id", "n", "label").hint("merge").join(of.select("gram", "e", F.col("top.label").alias("top"), F.ceil(F.col("e") / BLOCK).alias("all_parts"), F.ceil((F.col("e") - F.col("top.k")) / BLOCK).alias("few_parts")), "gram")
        own = lambda parts: F.pmod(F.xxhash64("id"), F.col(parts))
        spread = lambda parts: F.explode(F.sequence(F.lit(0).cast("long"), F.col(parts) - 1))
        few = rows.where("label <> top").select("gram", own("few_parts").alias("i"), spread("all_parts").alias("j"), "id", "n", "label", F.lit(0).alias("side"))
        every = rows.select("gram", spread("few_parts").alias("i"), own("all_parts").alias("j"), "id", "n", "label", F.lit(1).alias("side"))
        fold, may, percent = self.fold, self.may_fold, self.percent

        def folded(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fold(s) for s in b.column(1).to_pylist()], pa.binary())], names=["id", "sig"])

        sigs = self.sets.select(F.col("row").alias("id"), "sig").mapInArrow(folded, "id long, sig binary")
        met = few.union(every).hint("merge").join(sigs, "id")

        def done(group):
            side, ids, n, labels = (np.array([r[k] for r in group]) for k in range(4))
            sig = np.frombuffer(b"".join(r[4] for r in group), np.uint8).reshape(len(group), -1)
            others = np.flatnonzero(side == 1)
            for k in np.flatnonzero(side == 0):
                o = others[(labels[others] != labels[k]) & (np.minimum(n[others], n[k]) * 100 >= np.maximum(n[others], n[k]) * percent)]
                o = o[may(sig[o], sig[k], n[o], n[k])] if len(o) else o
                if len(o):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[o], ids[k])), pa.array(np.maximum(ids[o], ids[k])), pa.array(np.full(len(o), 1, np.int32))], names=["a", "b", "parts"])

        def pairs(batches):
            key, group = None, []
            for b in batches:
                for gram, i, j, *rest in zip(*(b.column(c).to_pylist() for c in ("gram", "i", "j", "side", "id", "n", "label", "sig"))):
                    if (gram, i, j) != key:
                        if len(group) > 1:
                            yield from done(group)
                        key, group = (gram, i, j), []
                    group.append(rest)
            if len(group) > 1:
                yield from done(group)

        return met.repartition("gram", "i", "j").sortWithinPartitions("gram", "i", "j").mapInArrow(pairs, "a long, b long, parts int")

    def all(self, postings: DataFrame) -> DataFrame:
        """Every link (a, b), a < b, between sets that share a key: as many rows as there are links, so not for big groups of copies."""
        return self.verified(self.bounded(self.blocks(postings.withColumn("label", F.col("id"))))).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def spanning(self, postings: DataFrame) -> DataFrame:
        """Links (a, b) that join every component, from ``postings`` (gram, id, n)."""
        parts = F.pow(F.lit(2), F.greatest(F.lit(0), F.ceil(F.log2(F.col("entries") / CHUNK)))).cast("int").alias("parts")
        links, open_ = self.sets.sparkSession.createDataFrame([], "a long, b long"), postings.withColumn("label", F.col("id"))
        for turn in range(ROUNDS):
            # the first round has one order of the sets, so that a group meets few pivots; what is left meets up to eight a round
            order = F.xxhash64("id", F.lit(turn), F.pmod("gram", F.lit(8 if turn else 1)))
            of = open_.groupBy("gram").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min(F.struct(order.alias("h"), "id", "n", "label")).alias("p"), F.count("*").alias("entries"))
            of = cut(of.where("lo < hi").select("gram", F.col("p.id").alias("p"), F.col("p.n").alias("pn"), F.col("p.label").alias("pl"), "entries"), "pivots")
            open_ = cut(open_.select("gram", "id", "n", "label").hint("merge").join(of, "gram"), "open-postings")
            proposed = open_.where((F.col("label") != F.col("pl")) & self.near()).select(F.col("p").alias("a"), F.col("id").alias("b"), parts)
            links = cut(links.union(self.verified(self.bounded(proposed))), "links")
            # a key of two sets has had its only pair looked at
            open_ = cut(open_.where("entries > 2").select("gram", "id", "n").hint("merge").join(components(links, None if turn + 1 == ROUNDS else 1), "id", "left").withColumn("label", F.coalesce("label", "id")), "labelled-postings")
        return cut(links.union(self.verified(self.bounded(self.blocks(open_)))), "links")


def named(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(digest, component) of each class (id, digest, least): the least ``least`` of its component."""
    labelled = cut(classes.select("id", "digest", "least").hint("merge").join(components(links), "id", "left").withColumn("label", F.coalesce("label", "id")), "class-labels")
    least = labelled.groupBy("label").agg(F.min("least").alias("component"))
    return labelled.hint("merge").join(least, "label").select("digest", "component")
