"""Operator 5, line dedup: two Bloom filters for once-seen and twice-seen lines, then exact counts of the suspects only.

1. Each task hashes the distinct line keys of its documents and hands on, per segment of the filters, the bits of keys it saw
   at all and of those it saw twice. One task a segment merges them: a bit that is set and comes again goes to the twice-seen
   filter. A key of two documents always has all its bits there.
2. Only keys that the twice-seen filter knows ("suspects") are shuffled, as text, and counted exactly, with the first document.
3. Lines of keys that are common enough go; with ``keep="first"`` the first occurrence stays.

The filters have ``BITS_PER_LINE`` bits a line but ``MAX_BITS`` at most, which bounds what is sent to the driver and back to
executors (128 MB). Beyond some 67 million lines the filter fills up and more lines are suspects; the result stays exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SideTable, cut, located, read, runs

SPACE = b" \t\n\x0b\x0c\r"
BITS_PER_LINE, MIN_BITS, MAX_BITS, SEGMENTS = 16, 1 << 16, 1 << 30, 256


def line_key(line: bytes) -> bytes:
    """White space stripped at both ends, A-Z in lower case."""
    return line.strip(SPACE).lower()


def _keys(text: bytes, min_chars: int) -> set[bytes]:
    keys = set(map(line_key, text.split(b"\n")))
    return {k for k in keys if len(k) >= min_chars and (len(k) >= 4 * min_chars or len(k.decode()) >= min_chars)}


def _hashes(keys: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, keys), dtype=np.uint64, count=len(keys))


def _bits(h: np.ndarray, m: int) -> np.ndarray:
    """The two bits of each key."""
    return np.stack([h & np.uint64(m - 1), (h >> np.uint64(34)) & np.uint64(m - 1)])


def _texts(column) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def twice_seen(lines: DataFrame, m: int, min_chars: int) -> np.ndarray:
    """The twice-seen filter of ``m`` bits, packed, over column ``text``."""
    size = m // SEGMENTS

    def seen(batches):
        parts = [_hashes([k for t in _texts(b.column(0)) for k in _keys(t, min_chars)]) for b in batches]
        if not parts:
            return
        h, n = np.unique(np.concatenate(parts), return_counts=True)
        once, twice = np.unique(_bits(h, m)), np.unique(_bits(h[n > 1], m))
        at = np.arange(SEGMENTS + 1, dtype=np.uint64) * np.uint64(size)
        i, j = np.searchsorted(once, at), np.searchsorted(twice, at)
        of = lambda a, k, at=at: (a - at[k]).astype("<u4").tobytes()
        rows = [(k, of(once[i[k] : i[k + 1]], k), of(twice[j[k] : j[k + 1]], k)) for k in range(SEGMENTS) if i[k + 1] > i[k]]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=["seg", "once", "twice"])

    def merge(batches):
        held, once, twice = None, None, None
        for b in batches:
            for seg, a, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if seg != held:
                    if held is not None:
                        yield _packed(held, twice)
                    held, once, twice = seg, np.zeros(size, bool), np.zeros(size, bool)
                a = np.frombuffer(a, "<u4")
                twice[a[once[a]]] = True
                twice[np.frombuffer(c, "<u4")] = True
                once[a] = True
        if held is not None:
            yield _packed(held, twice)

    def _packed(seg, bits):
        return pa.RecordBatch.from_arrays([pa.array([seg], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["seg", "bits"])

    rows = lines.mapInArrow(seen, "seg int, once binary, twice binary").repartition("seg").sortWithinPartitions("seg")
    out = np.zeros(m // 8, np.uint8)
    for r in rows.mapInArrow(merge, "seg int, bits binary").collect():  # 128 MB at most
        out[r.seg * (size // 8) : (r.seg + 1) * (size // 8)] = np.frombuffer(r.bits, np.uint8)
    return out


def suspects(docs: DataFrame, bits: np.ndarray, min_chars: int) -> DataFrame:
    """The rows of ``docs`` (doc, home, at; text comes last) once for each distinct key of the text that the filter knows, with the key."""
    m, shared, own = len(bits) * 8, docs.sparkSession.sparkContext.broadcast(bits), docs.columns[:-1]

    def scan(batches):
        known = shared.value
        for b in batches:
            keys, owner = [], []
            for i, t in enumerate(_texts(b.column(b.num_columns - 1))):
                found = _keys(t, min_chars)
                keys.extend(found)
                owner.extend([i] * len(found))
            if keys:
                at = _bits(_hashes(keys), m)
                hit = np.flatnonzero(((known[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)).tolist()
                rows = b.select(own).take(pa.array([owner[i] for i in hit], pa.int64()))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([keys[i] for i in hit], pa.binary()).cast(pa.string())], names=[*own, "key"])

    return docs.mapInArrow(scan, ", ".join(f"{c} long" for c in own) + ", key string")


def repeated(found: DataFrame, counted: DataFrame) -> DataFrame:
    """(home, at, key, first) for each repeated key of each row; first: whether the row's document is the first that has it."""
    return found.hint("merge").join(counted.select("key", F.col("first").alias("first_doc")), "key").select("home", "at", "key", (F.col("doc") == F.col("first_doc")).alias("first"))


def dedup_lines(docs: DataFrame, min_docs: int = 2, min_chars: int = 1, keep: str = "first", doc_id: str = "doc_id", text: str = "text", min_words: int = 1) -> DataFrame:
    """``docs`` with ``text`` less its repeated lines, and n_lines (before) and n_dropped.

    A line's key is the line without white space at its ends, A-Z in lower case. Keys of at least ``min_chars`` code points and
    ``min_words`` words found in at least ``min_docs`` documents are repeated: all their lines go, in every document, or with ``keep="first"`` all
    but the first line in the document of least id. Each row is a document; a document with a line many times counts once for
    it. Rows that share an id lose the same keys, and keep the same firsts. NULL and empty texts have one empty line and stay
    empty; a NULL id works as any other (its row is known by its text). A very long text is held whole, in one worker, as a list of
    its lines. Columns named n_lines or n_dropped are replaced, all others may have any names. An empty table gives no rows.

    Texts are never shuffled: the repeated keys of a row are laid beside its file, and the last pass reads both.
    """
    if keep not in ("first", "none") or min_docs < 2:
        raise ValueError("keep: first or none; min_docs: 2 or more")
    cols = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows, home, at = located(docs.select(*cols))
    # a row without an id is known by its text; rows that meet under one key lose the same keys anyway
    doc = F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(text))
    plain = rows.select(doc.alias("doc"), F.col(home).alias("home"), F.col(at).alias("at"), F.col(text).cast("string").alias("text"))
    n = plain.agg(F.sum(F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"))) + 1)).head()[0] or 0
    m = MIN_BITS
    while m < min(MAX_BITS, n * BITS_PER_LINE):
        m *= 2
    found = cut(suspects(plain, twice_seen(plain.select("text"), m, min_chars), min_chars), "suspect-lines")
    # written, so that the join below has a shuffle on either side and a key of many documents can be split
    counted = cut(found.groupBy("key").agg(F.count("*").alias("n"), F.min("doc").alias("first")).where((F.col("n") >= min_docs) & (F.size(F.split("key", r"[\x20\x09-\x0D]+")) >= min_words)), "repeated-lines")
    side, first = SideTable(repeated(found, counted), "home", "at", "lines-to-drop"), keep == "first"

    def clean(batches):
        cursor = side.cursor()
        for b in batches:
            homes, places = b.column(home).to_numpy(), b.column(at).to_numpy()
            drop = {}
            for run in runs(homes):
                entries = cursor.take(int(homes[run.start]), places[run])
                if entries is not None:
                    where = np.searchsorted(places[run], entries.column("at").to_numpy()) + run.start
                    for i, key, is_first in zip(where.tolist(), entries.column("key").to_pylist(), entries.column("first").to_pylist()):
                        drop.setdefault(i, {})[key.encode()] = first and is_first
            texts, before, gone = [], [], []
            for i, t in enumerate(_texts(b.column(text))):
                lines = t.split(b"\n")
                before.append(len(lines))
                keys, kept = drop.get(i), lines
                if keys:
                    kept = []
                    for line in lines:
                        k = line_key(line)
                        if k not in keys:
                            kept.append(line)
                        elif keys[k]:
                            keys[k] = False
                            kept.append(line)
                gone.append(len(lines) - len(kept))
                texts.append(t if kept is lines else b"\n".join(kept))
            new = {text: pa.array(texts, pa.binary()).cast(pa.string())}
            yield pa.RecordBatch.from_arrays([*(new.get(c, b.column(c)) for c in cols), pa.array(before, pa.int64()), pa.array(gone, pa.int64())], names=[*cols, "n_lines", "n_dropped"])

    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == text else f.dataType) for f in docs.select(*cols).schema] + [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return rows.mapInArrow(clean, schema)


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without the lines that ten documents or more share."""
    out = dedup_lines(read(spark, sf_dir, "documents", "doc_id", "text"), min_docs=10, min_chars=1, keep="none")
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
each AS (SELECT rid, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM lines),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM each),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT rid) >= 10),
marked AS (SELECT k.*, c.key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid, doc_id"""
