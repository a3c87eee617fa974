"""Helpers shared by the training-data operators: tables, the shared folder, worker-side files, tokenizers."""

from __future__ import annotations

import json
import re
import uuid
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Stands for a NULL id in join and sort keys; the NULL comes back in results.
NULL_KEY = -(2**63)


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder of the session."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession, size: str = "16m"):
    """Within it, rows go to Python in batches of ``size`` bytes: whole texts are long, and a batch is held on both sides."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def cut(df: DataFrame, name: str, schema=None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, so a lost executor costs no recomputation."""
    path = scratch(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.option("parquet.block.size", 32 << 20).parquet(path)  # row groups of 32 MB, so that a writer holds no more
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def key_of(column) -> F.Column:
    """A bigint id as a key that is never NULL."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c, F.lit(NULL_KEY))


def key_back(column) -> F.Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c != F.lit(NULL_KEY), c)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def located(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with two more columns, whose names come along: a number of the row's Parquet file and the row's place in it. The
    same row has the same ones in every scan, however the files are dealt to tasks. What is no plain Parquet scan is written first."""
    home, at = fresh(docs, "home", "at")
    if _plain_scan(docs):
        try:
            of = docs.metadataColumn("_metadata")
            return docs.select(*docs.columns, F.xxhash64(of["file_path"]).alias(home), of["row_index"].alias(at)), home, at
        except AnalysisException:
            pass
    return located(cut(docs, "rows"))


def _plain_scan(docs: DataFrame) -> bool:
    """Whether ``docs`` reads files and at most picks columns and rows of them."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation"


def open_fs(path: str):
    """(file system, path inside it) of a URI, by pyarrow; used inside tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else re.sub(r"^file:/*", "/", path))


class SideTable:
    """A table that tasks read beside files of rows: split by ``home`` into folders, each sorted by ``key``. A task that goes
    through rows of a home in order of ``key`` takes the entries of those rows, a batch at a time; the rows are not shuffled."""

    def __init__(self, table: DataFrame, home: str, key: str, name: str, *then: str):
        self.key, self.path, self.home = key, scratch(table.sparkSession, name), home
        self.columns = [c for c in table.columns if c != home]
        table.repartition(home).sortWithinPartitions(home, key, *then).write.partitionBy(home).parquet(self.path)

    def cursor(self) -> _Cursor:
        return _Cursor(self)


class _Cursor:
    def __init__(self, side: SideTable):
        self.side, self.home, self.last = side, None, 0

    def _open(self, home: int, first: int) -> None:
        import pyarrow.dataset as ds
        from pyarrow import fs as files

        self.home, self.held, self.batches = home, None, iter(())
        fs, inner = open_fs(f"{self.side.path}/{self.side.home}={home}")
        if fs.get_file_info(inner).type != files.FileType.NotFound:
            self.batches = iter(ds.dataset(inner, filesystem=fs, format="parquet").to_batches(
                columns=self.side.columns, filter=ds.field(self.side.key) >= first, batch_size=1 << 14, batch_readahead=1, fragment_readahead=1))

    def take(self, home: int, keys):
        """Entries (a table, or None) whose key is one of ``keys``, a rising array of one home."""
        import numpy as np
        import pyarrow as pa

        if home != self.home or keys[0] <= self.last:
            self._open(home, int(keys[0]))
        self.last = keys[-1]
        got = []
        while True:
            if self.held is None:
                self.held = next(self.batches, None)
                if self.held is None:
                    break
            k = self.held.column(self.side.key).to_numpy()
            n = int(np.searchsorted(k, keys[-1], "right"))
            if n:
                got.append(self.held.slice(0, n).filter(pa.array(np.isin(k[:n], keys))))
            if n < len(k):
                self.held = self.held.slice(n)
                break
            self.held = None
        return pa.Table.from_batches(got) if got else None


def runs(homes):
    """Slices of rows of one home that follow each other."""
    import numpy as np

    ends = (np.flatnonzero(np.diff(homes)) + 1).tolist()
    for i, j in zip([0, *ends], [*ends, len(homes)]):
        if j > i:
            yield slice(i, j)


def picked(docs: DataFrame, home: str, at: str, rows: DataFrame, leave: bool = False) -> DataFrame:
    """The rows of ``docs`` (see ``located``) whose place is in ``rows`` (home, at), or with ``leave`` the others; the two columns go."""
    side, cols = SideTable(rows.select(F.col(home).alias("home"), F.col(at).alias("at")), "home", "at", "picked-rows"), [c for c in docs.columns if c not in (home, at)]

    def pick(batches):
        import numpy as np
        import pyarrow as pa

        cursor = side.cursor()
        for b in batches:
            homes, places = b.column(home).to_numpy(), b.column(at).to_numpy()
            hit = np.zeros(b.num_rows, bool)
            for run in runs(homes):
                found = cursor.take(int(homes[run.start]), places[run])
                if found is not None:
                    hit[run] = np.isin(places[run], found.column("at").to_numpy())
            yield b.select(cols).filter(pa.array(hit != leave))

    return docs.mapInArrow(pick, docs.select(*cols).schema)


def publish(path: str, write) -> None:
    """Write a file under a name of this attempt, then rename: a reader never sees half a file of a lost task."""
    fs, inner = open_fs(path)
    fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    tmp = f"{inner}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(tmp, compression=None) as out:
        write(out)
    fs.move(tmp, inner)


class ChunkTable:
    """Ids of chunks of text, each found once: chunk -> number -> a slice of one array of ids, and a score. Beyond ``entries``
    chunks it forgets those that came in fewer than two portions since it last did, or all but its first if that is not half.
    A subclass has ``_learn``, which must ``_keep`` each chunk it is given."""

    FIRST = "\x02"

    def __init__(self, entries: int):
        self.entries = entries
        self._clear()

    def _clear(self) -> None:
        import numpy as np

        self.known, self.flat, self.used = {}, np.zeros(1 << 16, "<u4"), 0
        self.starts, self.lens, self.scores, self.hits = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32), np.zeros(1 << 14), np.zeros(1 << 14, np.int16)
        self.fixed = 0

    def _forget(self) -> None:
        import numpy as np

        n = len(self.known)
        stay = self.hits[:n] > 1
        stay[: self.fixed] = True
        if stay.sum() > self.entries // 2:
            return self._clear()
        names, numbers = list(self.known), np.flatnonzero(stay)
        ids, ends = self._gather(numbers)
        self.flat, self.used, self.known = ids, len(ids), {names[i]: k for k, i in enumerate(numbers.tolist())}
        self.lens, self.scores = self.lens[numbers], self.scores[numbers]
        self.starts, self.hits = (ends - self.lens).astype(np.int32), np.ones(len(numbers), np.int16)

    def _keep(self, chunks: list[str], ids: list[list[int]], prefix: str = "", scores=0.0) -> None:
        import numpy as np

        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        n, total = len(self.known), int(lens.sum())
        if len(self.starts) < n + len(ids):
            self.starts, self.lens, self.scores, self.hits = (np.resize(x, 2 * n + len(ids)) for x in (self.starts, self.lens, self.scores, self.hits))
        if len(self.flat) < self.used + total:
            self.flat = np.resize(self.flat, 2 * self.used + total)
        self.flat[self.used : self.used + total] = [i for x in ids for i in x]
        self.starts[n : n + len(ids)] = self.used + np.cumsum(lens) - lens
        self.lens[n : n + len(ids)], self.scores[n : n + len(ids)], self.hits[n : n + len(ids)] = lens, scores, 0
        self.used += total
        for i, c in enumerate(chunks):
            self.known[prefix + c] = n + i

    def _of(self, chunk: str) -> list[int]:
        at = self.known[chunk]
        return self.flat[self.starts[at] : self.starts[at] + self.lens[at]].tolist()

    def _numbers(self, chunks: list[str]):
        """Numbers of distinct chunks."""
        import numpy as np

        if len(self.known) > self.entries:
            self._forget()
        known = self.known
        new = [c for c in chunks if c not in known]
        if new:
            self._learn(new)
        numbers = np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))
        self.hits[numbers] = np.minimum(self.hits[numbers], 999) + 1
        return numbers

    def _gather(self, numbers):
        """Flat ids of chunks in a row, and where each ends."""
        import numpy as np

        lens = self.lens[numbers]
        ends = np.cumsum(lens, dtype=np.int64)
        return self.flat[np.repeat(self.starts[numbers] - ends + lens, lens) + np.arange(ends[-1] if len(ends) else 0)], ends


def portions(texts, size: int):
    """Lists of texts of an Arrow string array, about ``size`` bytes or one text each; NULL is empty."""
    import numpy as np
    import pyarrow.compute as pc

    texts = pc.fill_null(texts, "")
    total, at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + size)))
        yield texts.slice(at, to - at).to_pylist()
        at = to


class ChunkEncoder(ChunkTable):
    """Ids of whole texts from a ``tokenizers`` file.

    Files whose rules are not among ``SPLITS`` get whole texts. For the others: a text of printable characters in which no two white-space characters meet is cut before each space and newline. Both
    public tokenizers split there themselves before any merge, so the ids of the chunks in a row are the ids of the text. The
    chunks of a batch are numbered by Arrow, and each chunk that is not known yet goes through the library once: a plain Latin
    word through its BPE model, which gives what the whole library gives (checked when the file is read), the rest many at
    a time with a mark between them. Other texts are cut at the safe places only. Memory is bounded: at most ``entries`` chunks
    are kept, for all tasks of a worker, and about ``portion`` bytes of text are taken at a time (some 250 MB a worker in all).
    """

    MARK, TAILS = "\x01", ".,;:!?"
    # --- Fixed values: rules of tokenizer files that split before each space and newline, and what comes before and after them ---
    SPLITS = (
        {"normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}},
        {"normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
         "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
             {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
             {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}},
    )
    _ODD = re.compile(r"\s\s|^\s|\s$")
    #: Where a text with other white space is cut: before a space or newline between two other characters.
    _CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
    _WHOLE = re.compile(r"([\n\x02]?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)")
    _made: dict[tuple[str, int], ChunkEncoder] = {}

    @classmethod
    def of(cls, path: str, entries: int = 700_000) -> ChunkEncoder:
        """The encoder of this worker process."""
        if (path, entries) not in cls._made:
            cls._made[path, entries] = cls(path, entries)
        return cls._made[path, entries]

    def __init__(self, path: str, entries: int = 700_000, portion: int = 3 << 20):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.portion = Tokenizer.from_file(path), portion
        rules = json.loads(self.tokenizer.to_str())
        #: Whether the file's rules are known to split at white space; if not, whole texts go through the library.
        self.splits = any(all(rules[k] == v for k, v in known.items()) for known in self.SPLITS) and rules["model"]["type"] == "BPE" and not any(
            rules[k] for k in ("post_processor", "truncation", "padding")) and not rules["model"].get("dropout")
        if not self.splits:
            return
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.mark, self.first = self._ids(" " + self.MARK), len(self._ids("\n.")) - len(self._ids("."))
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = str.maketrans({chr(b): level.pre_tokenize_str(bytes([b]).decode("latin-1"))[0][0][-1] for b in range(33, 127)})
        for c in "ÀÖØöøÿ\u0080\u00bf\u0100\u013f":
            for b, x in zip(c.encode(), level.pre_tokenize_str(c)[0][0]):
                self.bytes[b] = x
        for b in range(128, 192):
            self.bytes[b] = level.pre_tokenize_str(bytes([0xC3, b]).decode())[0][0][1]
        self.bytes[0xC3] = level.pre_tokenize_str("Ã")[0][0][0]
        self.bytes[32] = level.pre_tokenize_str(" ")[0][0]
        self.lower, self.spaced = list(self._ids("AB")) == list(self._ids("ab")), list(self._ids(" a")) != list(self._ids("a"))
        probes = ["the", "Straße", "ÉTÉ", "xyzzyq", "où", "ñandú", "INTERNATIONAL", "þÿ"]
        self.plain = all(self._word(w) == self._ids(" " + w).tolist() for w in probes)
        super().__init__(entries)

    def _clear(self) -> None:
        super()._clear()
        self._keep([*self.TAILS, "\n"], [self._ids(c).tolist() for c in (*self.TAILS, "\n")], prefix=self.FIRST + self.FIRST)
        self.fixed = len(self.known)

    def _ids(self, text: str):
        import numpy as np

        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _word(self, word: str) -> list[int]:
        """Ids of a plain word after a space, or with FIRST before it, of the word alone."""
        return self._words([word])[0]

    def _words(self, words: list[str]) -> list[list[int]]:
        tokenize, space, out = self.tokenizer.model.tokenize, self.bytes[32] if self.spaced else "", []
        for w in words:
            before = space
            if w[0] == self.FIRST:
                before, w = "", w[1:]
            if self.lower:
                w = w.lower()
            if not w.isascii():  # an ASCII letter stands for its own byte
                w = w.encode().decode("latin-1").translate(self.bytes)
            out.append([t.id for t in tokenize(before + w)])
        return out

    def _learn(self, chunks: list[str]) -> None:
        """A chunk stands after a space that is left out, or begins with its newline, or with FIRST where its text begins."""
        known, cores, rest, whole, match = self.known, {}, [], [], self._WHOLE.fullmatch
        for p in chunks:
            m = match(p) if self.plain else None  # letters and a stop after them are always apart
            if m is None:
                rest.append(p)
                continue
            lead, body, tail = m.groups()
            core = self.FIRST + body if lead and self.spaced else body
            cores[core] = None
            if core is not body or lead or tail:
                whole.append((p, lead, core, tail))
        new = [c for c in cores if c not in known]
        made = self._words(new)
        self._keep(new, made)
        of = dict(zip(new, made))
        tails = {c: self._of(self.FIRST * 2 + c) for c in (*self.TAILS, "\n")} | {"": [], self.FIRST: []}
        whole = [w for w in whole if w[0] not in known]
        self._keep([w[0] for w in whole], [[*tails[lead], *(of[core] if core in of else self._of(core)), *tails[tail]] for _, lead, core, tail in whole])
        lead = {"\n": "", self.FIRST: ""}
        for i in range(0, len(rest), 4096):
            some = rest[i : i + 4096]
            import numpy as np

            ids = self._ids("".join([" " + self.MARK + (lead.get(p[0], " ") + (p if p[0] != self.FIRST else "\n" + p[1:])) for p in some]))
            at = np.flatnonzero(ids == self.mark[-1]) + 1
            if len(at) != len(some):
                raise AssertionError("the mark does not stand alone")
            ends, flat = [*(at[1:] - len(self.mark)).tolist(), len(ids)], ids.tolist()
            self._keep(some, [flat[a + (self.first if p[0] == self.FIRST else 0) : b] for p, a, b in zip(some, at.tolist(), ends)])

    def _is_plain(self, t: str) -> bool:
        u = t.replace("\n", " ")
        return bool(t) and u.isprintable() and "  " not in u and u[0] != " " and u[-1] != " " and not any(s in t for s in self.special)

    def __call__(self, text: str | None):
        """Ids of one text."""
        import pyarrow as pa

        return next(iter(self.each(pa.array([text], pa.string()))))

    def each(self, texts):
        """Ids (uint32 array) of each text of an Arrow string array, in order; NULL has none."""
        import numpy as np
        import pyarrow as pa

        for some in portions(texts, self.portion):
            if self.splits:
                yield from self._portion(some)
            else:
                for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False):
                    yield np.asarray(e.ids, dtype="<u4")
        pa.default_memory_pool().release_unused()

    def _portion(self, texts: list[str]):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        plain = [self._is_plain(t) for t in texts]
        rows = pa.array([self._row(t) for t, ok in zip(texts, plain) if ok], pa.large_string())
        split = pc.split_pattern(rows, " ")
        coded = split.flatten().dictionary_encode()
        ids, ends = self._gather(self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)])
        ends = np.concatenate([[0], ends])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        k = 0
        for t, ok in zip(texts, plain):
            if ok:
                yield ids[ends[k] : ends[k + 1]]
                k += 1
            else:
                yield self._odd(t)

    def _row(self, t: str) -> str:
        """A plain text with a space before each chunk but the first."""
        if self.spaced:
            return self.FIRST + t.replace("\n", " \n")
        t = t.replace("\n", " ")  # where a chunk has no ids for what stands before it, all may stand after a space
        return t.lower() if self.lower and t.isascii() else t

    def _odd(self, text: str):
        import numpy as np

        if not text or self.MARK in text or self.FIRST in text or any(s in text for s in self.special):
            return self._ids(text)
        out, run = [], []
        for i, p in enumerate(self._CUT.split(text)):
            if self._ODD.search(p[1:] if i else p):
                out += [self._run(run), self._ids(p)]
                run = []
            else:
                run.append(p.removeprefix(" ") if i else self.FIRST + p)
        return np.concatenate([*out, self._run(run)])

    def _run(self, run: list[str]):
        unique = list(dict.fromkeys(run))
        number = dict(zip(unique, self._numbers(unique).tolist()))
        import numpy as np

        return self._gather(np.array([number[p] for p in run], np.int64))[0]
