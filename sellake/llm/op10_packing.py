"""Operator 10, packing: power-of-two decomposition.

Each document's ids are cut into pieces whose lengths are powers of two, the largest first: as many of ``max_len`` as fit,
then the binary digits of the rest. Each piece is a sequence of its own, and sequences of equal length share a bucket, so no
sequence crosses documents and none needs padding. A very long text is encoded in one piece and leaves in portions of rows. Only
the id and the text are read, so other columns may have any names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ChunkEncoder, read, scratch, small_batches

_PIECES = "sequence_id long, doc_id long, start long, length int, doc_tokens long, ids binary"
_SCHEMA = pa.schema([("sequence_id", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()), ("doc_tokens", pa.int64()), ("ids", pa.binary())])
_FLUSH = 4 << 20


def piece_lengths(n: int, max_len: int = 2048) -> list[int]:
    """Powers of two that sum to ``n``, none above ``max_len``, in falling order."""
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    rest = n % max_len
    return [max_len] * (n // max_len) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer: str, end_id: int, max_len: int = 2048, doc_id: str = "doc_id", text: str = "text", entries: int = 700_000) -> DataFrame:
    """One row per sequence: ``sequence_id``, ``doc_id``, ``start`` (its document's ids before it), ``length``, ``doc_tokens``
    (with the end id) and ``ids`` (little-endian uint32).

    Nothing is shuffled: a piece depends on its document alone. ``sequence_id`` is the input partition times 2**36 plus a
    count, the same again when a lost task is repeated over the same input. NULL and empty texts give one sequence with the
    end id; NULL ids stay NULL; repeated rows are packed one by one; an empty table gives no sequences. ``entries``: chunks of text
    whose ids a worker remembers (some 500 bytes each).
    """
    piece_lengths(0, max_len)

    def cut_up(batches):
        encode, end = ChunkEncoder.of(tokenizer, entries), np.array([end_id], dtype="<u4").tobytes()
        number, rows, held = TaskContext.get().partitionId() << 36, {n: [] for n in _SCHEMA.names}, 0
        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), encode.each(batch.column(1))):
                ids = memoryview(ids.tobytes() + end)
                total, at = len(ids) // 4, 0
                for n in piece_lengths(total, max_len):
                    for name, v in zip(_SCHEMA.names, (number, doc, at, n, total, bytes(ids[4 * at : 4 * (at + n)]))):
                        rows[name].append(v)
                    number, at, held = number + 1, at + n, held + 4 * n + 64
                    if held > _FLUSH:
                        yield pa.RecordBatch.from_pydict(rows, schema=_SCHEMA)
                        rows, held = {n: [] for n in _SCHEMA.names}, 0
        if held:
            yield pa.RecordBatch.from_pydict(rows, schema=_SCHEMA)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(cut_up, _PIECES)


def write_buckets(pieces: DataFrame, path: str) -> DataFrame:
    """Write the sequences to one folder per length and read them back."""
    with small_batches(pieces.sparkSession):
        pieces.withColumn("bucket", F.col("length")).write.partitionBy("bucket").parquet(path)
    return pieces.sparkSession.read.schema(_PIECES + ", bucket int").parquet(path)


def digest(sequences: DataFrame) -> DataFrame:
    return sequences.select("doc_id", "start", F.col("length").cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"))


def packed_documents(spark, docs: DataFrame, entries: int = 700_000) -> DataFrame:
    """The sequences of ``docs`` by the public word tokenizer, written to their buckets and read back, one digest row a piece."""
    import public_tokenizers

    return digest(write_buckets(pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, entries=entries), scratch(spark, "sequences")))


def op10_packing(spark, sf_dir: str) -> DataFrame:
    """Whole ``documents`` packed into sequences of at most 2048 ids; SQL cannot tokenize, tests compare with the library."""
    return packed_documents(spark, read(spark, sf_dir, "documents"))
