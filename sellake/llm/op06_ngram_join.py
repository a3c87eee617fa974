"""Operator 6, n-gram Jaccard join: vertical partitioning.

The n-grams have one global order, rarest first: by classes of a frequency sketch over all documents, then by hash. Any fixed
order gives exact results; the sketch only keeps frequent n-grams out of the prefixes.

1. Each row becomes a sorted set of 56-bit n-gram hashes, its digest and a parity bitmap. Equal sets form one class, and
   one row stands for it, so copies are never paired.
2. Two sets with the wanted likeness share an n-gram of their prefixes (the first n - ceil(t n) + 1). Only n-grams that a
   twice-seen Bloom filter knows from several prefixes are shuffled.
3. ``ngram_components`` looks for links in rounds and blocks (``links.Links.spanning``): every component is found without the pairs
   within a big group. ``ngram_links`` gives every link between classes, with their members.
4. A proposed pair must pass the parity bound (differing bits never exceed the true difference). Then the global order is cut
   into fragments, the overlaps of a pair are counted fragment by fragment in separate tasks, and summed.

NULL, empty and wordless texts have no set and link with nothing. Each row is a document of its own, also where ids repeat; a
NULL id counts as the least and stays NULL. A very long text is one set, held whole in one worker (some 40 bytes a word). Only the
id and the text are read; other columns may have any names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, key_back, key_of, located, picked, read
from .links import Links, folded, may_differ, may_link, mix, named, parity, unpacked, write_sets
from .op05_line_dedup import MAX_BITS, MIN_BITS, SEGMENTS, _bits

#: N-grams for a bucket of the frequency sketch, buckets at most, and fragments of the global order.
PER_BUCKET, MAX_SKETCH, FRAGMENTS = 16, 1 << 27, 4
BITS_PER_ENTRY = 8


def _merged(parts: DataFrame, segments: int, size: int, dtype, add: Callable, finish: Callable = lambda x: x) -> bytes:
    """The segments of an array in a row, each merged from rows (seg, data); a task holds one segment at a time and hands on
    what ``finish`` makes of it. Segments without rows are zeros. The whole is of fixed size."""

    def merge(batches):
        held, total = None, None
        for b in batches:
            for seg, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if seg != held:
                    if held is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([held], pa.int32()), pa.array([finish(total).tobytes()], pa.binary())], names=["seg", "data"])
                    held, total = seg, np.zeros(size, dtype)
                add(total, data)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held], pa.int32()), pa.array([finish(total).tobytes()], pa.binary())], names=["seg", "data"])

    width = len(finish(np.zeros(size, dtype)).tobytes())
    done = parts.repartition("seg").sortWithinPartitions("seg").mapInArrow(merge, "seg int, data binary")
    out = bytearray(width * segments)
    for r in done.collect():  # at most as long as the whole, 128 MB; an iterator would run a job per partition
        out[r.seg * width : (r.seg + 1) * width] = r.data
    return out


def _class_of(count):
    return np.floor(4 * np.log2(count))


def _sketch(rows: DataFrame, total: int) -> np.ndarray:
    """Frequency class of each bucket of n-grams: four for each doubling of its count, so that even among rare n-grams those in
    lightly filled buckets come first. A bucket for every ``PER_BUCKET`` of the ``total`` n-grams, 2**16 buckets at least and
    MAX_SKETCH at most (one byte each, 128 MB)."""
    size = 1 << 16
    while size < min(MAX_SKETCH, total // PER_BUCKET):
        size *= 2
    width = size // 64

    def count(batches):
        import zstandard

        parts = [(g & np.uint64(size - 1)).astype(np.uint32) for b in batches for g in unpacked(b.column(0))]
        pack = zstandard.ZstdCompressor(level=1)
        if parts:
            buckets = np.concatenate(parts)
            parts.clear()
            buckets.sort()
            ends = np.searchsorted(buckets, np.arange(65, dtype=np.uint64) * np.uint64(width))
            for s in range(64):  # one segment at a time: its counts, like bytes together
                if ends[s + 1] > ends[s]:
                    held = np.bincount(buckets[ends[s] : ends[s + 1]] - np.uint32(s * width), minlength=width).astype("<u4")
                    data = pack.compress(np.ascontiguousarray(held.view(np.uint8).reshape(-1, 4).T).tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([data], pa.binary())], names=["seg", "data"])

    def add(held, data):
        import zstandard

        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
        held += np.ascontiguousarray(planes.T).reshape(-1).view("<u4")

    def classes(held):
        return _class_of(np.maximum(held, 1)).astype(np.uint8)

    return np.frombuffer(_merged(rows.select("grams").mapInArrow(count, "seg int, data binary"), 64, width, np.int64, add, classes), np.uint8)


def _order(g: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where each n-gram of a sorted set comes in the global order."""
    return np.lexsort((g, classes[(g & np.uint64(len(classes) - 1)).astype(np.int64)]))


def _prefix(g: np.ndarray, classes: np.ndarray, percent: int) -> np.ndarray:
    n = len(g)
    return g[_order(g, classes)[: n - -(-percent * n // 100) + 1]] if n else g


def _filter(parts: DataFrame, m: int) -> np.ndarray:
    """Packed bits from rows (seg, data) of ``_segments``: set where a bit was said to be set twice, or came again."""

    def add(total, data):
        n, pos = int(np.frombuffer(data, "<u4", 1)[0]), np.frombuffer(data, "<u4", offset=4)
        once, again = pos[:n], pos[n:]
        total[once] = np.where(total[once] > 0, 2, 1)
        total[again] = 2

    return np.frombuffer(_merged(parts, SEGMENTS, m // SEGMENTS, np.uint8, add, lambda x: np.packbits(x > 1, bitorder="little")), np.uint8)


def _segments(once: np.ndarray, again: np.ndarray, m: int) -> pa.RecordBatch:
    """Bits of hashes that a task saw, and of those it saw again, by segment."""
    once, again = np.unique(_bits(once, m)), np.unique(_bits(again, m))
    at = np.arange(SEGMENTS + 1, dtype=np.uint64) * np.uint64(m // SEGMENTS)
    i, j = np.searchsorted(once, at), np.searchsorted(again, at)
    rows = [(k, np.uint32(i[k + 1] - i[k]).tobytes() + (once[i[k] : i[k + 1]] - at[k]).astype("<u4").tobytes() + (again[j[k] : j[k + 1]] - at[k]).astype("<u4").tobytes()) for k in range(SEGMENTS) if i[k + 1] > i[k]]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["seg", "data"])


def _known(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = _bits(h, len(bits) * 8)
    return ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def _size(n: int) -> int:
    m = MIN_BITS
    while m < min(MAX_BITS, n * BITS_PER_ENTRY):
        m *= 2
    return m


def _twice(rows: DataFrame, classes, percent: int, m: int) -> np.ndarray:
    """Twice-seen filter of prefix n-grams."""

    def seen(batches):
        parts = [_prefix(g, classes.value, percent) for b in batches for g in unpacked(b.column(0))]
        if parts and len(all_ := np.concatenate(parts)):
            h, n = np.unique(all_, return_counts=True)
            h = mix(h)
            yield _segments(h, h[n > 1], m)

    return _filter(rows.select("grams").mapInArrow(seen, "seg int, data binary"), m)


def _postings(rows: DataFrame, classes, percent: int, known) -> DataFrame:
    """(gram, row, n) for prefix n-grams that may stand in several prefixes."""

    def emit(batches):
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                pre = [_prefix(g, classes.value, percent) for g in unpacked(part.column(2))]
                owner, g = np.repeat(np.arange(len(pre)), [len(p) for p in pre]), np.concatenate(pre)
                if len(g):
                    hit = _known(known.value, mix(g))
                    owner, g = owner[hit], g[hit]
                    yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(part.column(0).to_numpy()[owner]), pa.array(part.column(1).to_numpy()[owner])], names=["gram", "id", "n"])

    return rows.select("row", "n", "grams").mapInArrow(emit, "gram long, id long, n long")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    return write_sets(docs, size, lambda g: {"sig": parity(g)}, {"sig": pa.binary()}, ", sig binary")


def _search(rows: DataFrame, name: Column, percent: int) -> tuple[DataFrame, DataFrame, Links]:
    """Classes (id, digest, least) of the sets, the postings of one set a class, and what finds links in them."""
    spark = rows.sparkSession
    linkable = rows.where("n > 0")
    classes = cut(linkable.groupBy("digest").agg(F.min("row").alias("id"), F.min(name).alias("least")), "gram-classes")
    grams, entries = linkable.agg(F.sum("n"), F.sum(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)).head()
    sketch = spark.sparkContext.broadcast(_sketch(linkable, grams or 0))
    known = spark.sparkContext.broadcast(_twice(linkable, sketch, percent, _size(entries or 0)))
    postings = cut(_postings(linkable, sketch, percent, known).hint("merge").join(classes.select("id"), "id", "left_semi"), "postings")

    frequent = _class_of(2 * max(1.0, (grams or 0) / len(sketch.value)))

    def fragment(g):  # the frequent classes are the end of the order, and the last fragment
        held = sketch.value
        return np.where(held[(g & np.uint64(len(held) - 1)).astype(np.int64)] > frequent, FRAGMENTS - 1, (g >> np.uint64(24)).astype(np.int64) * (FRAGMENTS - 1) >> 32)

    return classes, postings, Links(linkable, percent, may_link(percent), folded, may_differ(percent), fragment, FRAGMENTS)


def _plain(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(key_of(F.col(doc_id).cast("long")).alias("doc"), F.col(text).cast("string").alias("text"))


def ngram_components(docs: DataFrame, size: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles and component_id, the least doc_id that links reach. Rows link when their sets of
    word ``size``-grams have 100 * intersection >= percent * union."""
    rows = _sets(_plain(docs, doc_id, text), size)
    classes, postings, links = _search(rows, F.col("doc"), percent)
    return rows.select("doc", "n", "digest").hint("merge").join(named(classes, links.spanning(postings)), "digest", "left").select(
        key_back("doc").alias("doc_id"), F.col("n").alias("n_shingles"), key_back(F.when(F.col("n") > 0, F.coalesce("component", "doc")).otherwise(F.col("doc"))).alias("component_id"))


def ngram_links(docs: DataFrame, size: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Every link: (class_a, class_b) between different sets, and the members (class_id, doc_id, n_shingles) of each class; rows of
    one class link as well. As long as there are links, so the square of a group of near copies; see ``ngram_components``."""
    rows = _sets(_plain(docs, doc_id, text), size)
    classes, postings, links = _search(rows, F.col("doc"), percent)
    members = rows.where("n > 0").hint("merge").join(classes, "digest").select(F.col("id").alias("class_id"), key_back("doc").alias("doc_id"), F.col("n").alias("n_shingles"))
    return links.all(postings).select(F.col("a").alias("class_a"), F.col("b").alias("class_b")), members


def keep_one(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """The rows of ``docs`` less all but one of each component: of its rows, the one of least id (NULL first), then of least hash of the
    text, then the first in the files. Rows without words all stay. Who goes is decided on row numbers; texts are read, never shuffled."""
    rows, home, at = located(docs)
    mark = F.unhex(F.md5(F.col("text").cast("string")))
    sets = _sets(rows.select(key_of(F.col("doc_id").cast("long")).alias("doc"), F.col("text").cast("string").alias("text"), mark.alias("mark"), F.col(home).alias("home"), F.col(at).alias("at")), size)
    name = F.struct("doc", "mark", "home", "at")
    classes, postings, links = _search(sets, name, percent)
    of = sets.where("n > 0").select("digest", "home", "at").hint("merge").join(named(classes, links.spanning(postings)), "digest")
    gone = of.where((F.col("home") != F.col("component.home")) | (F.col("at") != F.col("component.at")))
    return picked(rows, home, at, gone.select(F.col("home").alias(home), F.col("at").alias(at)), leave=True)


def op6_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Components of all documents at three-word shingles and a likeness of 0.9."""
    return ngram_components(read(spark, sf_dir, "documents", "doc_id", "text"), size=3, percent=90)
