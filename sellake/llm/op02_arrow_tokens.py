"""Operator 2, token-ID / binary output: Arrow stream-file format with fixed-size-list batches.

Documents are sorted by id into ranges. Each task encodes its range, joins the ids to one stream and cuts it into rows of
``seq_len`` ids with a mask of as many bits (false: padding, at the end of a file only). A file of ids has record batches of
``BATCH`` rows, so row ``i`` is batch ``i // BATCH``, and a reader maps it into memory without copying. A second file beside
it has the documents: id, first position, number of ids.

A very long text is encoded in one piece and handed on a record batch at a time. Only the id and the text are read, so other
columns may have any names.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import ChunkEncoder, cut, key_back, key_of, open_fs, publish, scratch

BATCH = 64
_MANIFEST = "part int, path string, n_rows long, n_docs long, n_tokens long"
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _file_schema(seq_len: int, id_type: str) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.field("item", pa.type_for_alias(id_type), False), seq_len)),
                      ("mask", pa.list_(pa.field("item", pa.bool_(), False), seq_len))])


class _Rows:
    """Takes ids in any portions and hands on whole record batches; at most one batch is held."""

    def __init__(self, writer, seq_len: int, id_type: str):
        self.writer, self.seq_len, self.dtype = writer, seq_len, np.dtype(id_type)
        self.schema, self.room = _file_schema(seq_len, id_type), np.zeros(BATCH * seq_len, self.dtype)
        self.used = self.rows = 0

    def add(self, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, len(self.room) - self.used)
            self.room[self.used : self.used + n] = ids[at : at + n]
            at, self.used = at + n, self.used + n
            if self.used == len(self.room):
                self.flush()

    def flush(self) -> None:
        if self.used:
            n = -(-self.used // self.seq_len)
            ids, mask = self.room[: n * self.seq_len].copy(), np.arange(n * self.seq_len) < self.used
            ids[self.used :] = 0
            self.writer.write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(v), type=f.type) for v, f in zip((ids, mask), self.schema)], schema=self.schema))
            self.rows, self.used = self.rows + n, 0


def write_token_files(docs: DataFrame, out_dir: str, tokenizer: str, end_id: int, seq_len: int = 2048, id_type: str = "uint16",
                      doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the token files of ``docs`` to ``out_dir`` (a folder all executors share) and return their manifest.

    Manifest: ``part`` (order of the files), ``path``, ``n_rows``, ``n_docs``, ``n_tokens``; only files it lists count. A task
    that runs twice leaves a file that no manifest lists. NULL and empty texts give the end id alone; NULL ids come first;
    rows with equal ids each count, ordered by text; an empty table gives an empty manifest. ``id_type`` must hold every id.
    """
    rows = docs.select(key_of(F.col(doc_id).cast("long")).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches):
        encode, end, most = ChunkEncoder.of(tokenizer), np.array([end_id], dtype="<u4"), np.iinfo(id_type).max
        part = TaskContext.get().partitionId()
        path, done = f"{out_dir}/{part:06d}-{uuid.uuid4().hex}", [0, 0, 0]

        def ids_of_all(out_docs, out):
            with pa.ipc.new_file(out_docs, _DOCS) as index, pa.ipc.new_file(out, _file_schema(seq_len, id_type)) as writer:
                sink, at = _Rows(writer, seq_len, id_type), 0
                for batch in batches:
                    starts, lengths = [], []
                    for ids in encode.each(batch.column("text")):
                        ids = np.concatenate([ids, end])
                        if len(ids) and int(ids.max()) > most:
                            raise ValueError(f"{id_type} cannot hold token id {ids.max()}")
                        sink.add(ids)
                        starts.append(at)
                        lengths.append(len(ids))
                        at += len(ids)
                    if starts:
                        index.write_batch(pa.record_batch([batch.column("doc_id").cast(pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())], schema=_DOCS))
                        done[1] += len(starts)
                sink.flush()
                done[0], done[2] = sink.rows, at

        publish(f"{path}.docs.arrow", lambda out_docs: publish(f"{path}.arrow", lambda out: ids_of_all(out_docs, out)))
        if done[1]:
            yield pa.RecordBatch.from_pylist([{"part": part, "path": path, "n_rows": done[0], "n_docs": done[1], "n_tokens": done[2]}],
                                             schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_rows", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    return cut(rows.mapInArrow(write, _MANIFEST), "token-manifest")


class TokenFile:
    """Random access to one token file: ``ids(i)`` and ``mask(i)`` of row ``i``. On a local path the ids are views of the mapped file."""

    def __init__(self, path: str):
        fs, inner = open_fs(f"{path}.arrow")
        local = type(fs).__name__ == "LocalFileSystem"
        self.reader = pa.ipc.open_file(pa.memory_map(inner) if local else fs.open_input_file(inner))
        docs, inner_docs = open_fs(f"{path}.docs.arrow")
        self.docs = pa.ipc.open_file(docs.open_input_file(inner_docs))
        self.seq_len = self.reader.schema.field("ids").type.list_size

    def batch(self, k: int) -> np.ndarray:
        """The ids of batch ``k`` as one flat array."""
        return self.reader.get_batch(k).column("ids").flatten().to_numpy(zero_copy_only=True)

    def ids(self, i: int) -> np.ndarray:
        at = i % BATCH * self.seq_len
        return self.batch(i // BATCH)[at : at + self.seq_len]

    def mask(self, i: int) -> np.ndarray:
        got = self.reader.get_batch(i // BATCH).column("mask")
        return got.slice(i % BATCH, 1).flatten().to_numpy(zero_copy_only=False)


def read_documents(manifest: DataFrame) -> DataFrame:
    """Read the files back: per document ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``
    (of the ids as little-endian uint32), ``part`` and ``first_row`` (row of its first id). A task reads whole files, a batch
    at a time. The running sum is over the manifest, one row a file."""

    def scan(batches):
        for batch in batches:
            for part, path in zip(batch.column("part").to_pylist(), batch.column("path").to_pylist()):
                file = TokenFile(path)
                width, held, flat = BATCH * file.seq_len, -1, None
                for b in range(file.docs.num_record_batches):
                    docs = file.docs.get_batch(b)
                    crcs = []
                    for start, n in zip(docs.column("start").to_pylist(), docs.column("n_tokens").to_pylist()):
                        crc, at, end = 0, start, start + n
                        while at < end:
                            if at // width != held:
                                held, flat = at // width, file.batch(at // width)
                            to = min(end, (held + 1) * width)
                            crc, at = zlib.crc32(flat[at - held * width : to - held * width].astype("<u4").tobytes(), crc), to
                        crcs.append(crc)
                    yield pa.record_batch([docs.column("doc_id"), pa.array([part] * docs.num_rows, pa.int32()), docs.column("start"), docs.column("n_tokens"), pa.array(crcs, pa.int64())],
                                          names=["doc_id", "part", "local_start", "n_tokens", "ids_crc32"])

    files = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
    rows = manifest.repartitionByRange(max(1, manifest.count()), "part").mapInArrow(scan, "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long")
    return rows.join(files.select("part", "before"), "part").select(
        key_back("doc_id").alias("doc_id"), (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", "part", "local_start")


def op2_arrow_tokens(spark, sf_dir: str) -> DataFrame:
    """Whole ``documents`` through the files and back; SQL cannot tokenize, tests compare with the library directly."""
    import public_tokenizers

    from .common import read

    manifest = write_token_files(read(spark, sf_dir, "documents", "doc_id", "text"), scratch(spark, "token-files"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return read_documents(manifest)
