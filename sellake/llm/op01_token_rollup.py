"""Operator 1, token counts: delta-maintained rollups.

A batch of changes becomes signed rows per document, source, language and tokenizer version: minus what the document
counted before, plus what it counts now. Their sums are added to the totals; no document outside the batch is counted again.
A batch is written to folders of its own and takes effect by one row in the table of commits, so a batch that is sent
again changes nothing, and one that was cut off is written anew. Readers see committed batches only; one writer at a time.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ChunkEncoder, cut, read, scratch

KEYS = ["source", "lang", "tokenizer"]
_COMMITS = "batch string, changes long"
_LEDGER = "doc_id long, source string, lang string, tokenizer string, docs long, tokens long"
_TOTALS = "source string, lang string, tokenizer string, docs long, tokens long"
#: Chunks a worker remembers per tokenizer; fewer than for writing ids, as several tokenizers may count at once.
ENTRIES = 350_000
#: A tokenizer version without a file: words between white space.
WORDS = "words"


def token_counts(docs: DataFrame, tokenizers: dict[str, str | None], text: str = "text") -> DataFrame:
    """``docs`` less its text as one row per tokenizer version, with ``tokenizer`` and ``tokens``. NULL and empty texts have none."""
    files = {k: v for k, v in tokenizers.items() if v is not None}
    plain = [k for k, v in tokenizers.items() if v is None]
    keep = [c for c in docs.columns if c not in (text, "tokenizer", "tokens")]

    def count(batches):
        encoders = [ChunkEncoder.of(p, ENTRIES) for p in files.values()]
        for b in batches:
            texts, cols = b.column(text), [b.column(c) for c in keep]
            found = {name: pa.array([len(ids) for ids in e.each(texts)], pa.int64()) for name, e in zip(files, encoders)}
            for name in plain:
                found[name] = pa.array([len(t.as_buffer().to_pybytes().split()) if t.is_valid else 0 for t in texts.cast(pa.binary())], pa.int64())
            for name, n in found.items():
                yield pa.RecordBatch.from_arrays([*cols, pa.array([name] * b.num_rows, pa.string()), n], names=[*keep, "tokenizer", "tokens"])

    schema = T.StructType([*docs.select(*keep).schema, T.StructField("tokenizer", T.StringType()), T.StructField("tokens", T.LongType())])
    return docs.select(*keep, text).mapInArrow(count, schema)


class TokenRollup:
    """Totals of documents and tokens by source, language and tokenizer version, in ``path`` (a shared folder).

    ``commit(batch, changes)``: ``changes`` has op (insert, revise, delete), doc_id, source, lang, text and seq. Of a document's
    changes in a batch the one of greatest seq counts (ties: the greatest op, then the greatest hash of the text). An insert of a known document
    revises it; a revision of an unknown one inserts it; a delete of an unknown one, and any other op, has no effect. A row without
    a doc_id is a document of its own, which no later change can name: each insert or revision adds one, a delete has no effect. A NULL
    source or lang is a value like any other. A very long text is counted in portions. Only the named columns are read, others may have
    any names. An empty batch is committed and changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, tokenizers: dict[str, str | None]):
        self.spark, self.path, self.tokenizers = spark, path.rstrip("/"), dict(tokenizers)
        spark.createDataFrame([], _COMMITS).write.mode("append").parquet(f"{self.path}/commits")

    def batches(self) -> list[str]:
        """Committed batches; as many rows as there were batches."""
        return sorted(r.batch for r in self.spark.read.schema(_COMMITS).parquet(f"{self.path}/commits").collect())

    def _committed(self, table: str, schema: str) -> DataFrame:
        paths = [f"{self.path}/{table}/{b}" for b in self.batches()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch; False if it was applied before."""
        if not re.fullmatch(r"[A-Za-z0-9][\w.-]*", batch):
            raise ValueError(f"batch id: {batch!r}")
        if batch in self.batches():
            return False
        # texts are counted where they are; only counts are shuffled to find a document's last change
        rows = changes.where(F.col("op").isin("insert", "revise", "delete")).select("op", "doc_id", "source", "lang", "seq", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("tie"), F.when(F.col("op") != "delete", F.col("text")).alias("text"))
        rows = rows.withColumn("alone", F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()))
        last = Window.partitionBy("doc_id", "alone", "tokenizer").orderBy(F.desc("seq"), F.desc("op"), F.desc("tie"))
        one = token_counts(rows, self.tokenizers).withColumn("nth", F.row_number().over(last)).where("nth = 1")
        one = cut(one.select("op", "doc_id", *KEYS, "tokens"), "changes")
        new = one.where("op <> 'delete'").select("doc_id", *KEYS, F.lit(1).cast("long").alias("docs"), "tokens")
        if self.batches():
            ledger = self._committed("ledger", _LEDGER)
            ids = one.where("doc_id is not null").select("doc_id").distinct()
            now = ledger.join(ids, "doc_id", "left_semi").groupBy("doc_id", *KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")
            new = now.select("doc_id", *KEYS, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens")).unionByName(new)
        new.write.mode("overwrite").parquet(f"{self.path}/ledger/{batch}")
        signed = self.spark.read.schema(_LEDGER).parquet(f"{self.path}/ledger/{batch}")
        signed.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).write.mode("overwrite").parquet(f"{self.path}/totals/{batch}")
        self.spark.createDataFrame([(batch, one.select("doc_id").distinct().count())], _COMMITS).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens: the sums of the committed batches; groups that came to nothing go."""
        sums = self._committed("totals", _TOTALS).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs <> 0 or tokens <> 0")


def feed(documents: DataFrame, labels: DataFrame) -> dict[str, DataFrame]:
    """Stand-in change batches: all documents are inserted; those of one source, which holds a third of the rows, are revised to
    less their last line; toxic ones are deleted."""
    rows = documents.select("doc_id", "source", "lang", "text")
    toxic = labels.where("toxic = 1").select("doc_id").distinct()
    as_batch = lambda df, op, text, seq: df.select(F.lit(op).alias("op"), "doc_id", "source", "lang", text.alias("text"), F.lit(seq).alias("seq"))
    return {
        "load": as_batch(rows, "insert", F.col("text"), 0),
        "revise": as_batch(rows.where("source = 'src0'"), "revise", F.regexp_replace("text", r"\n[^\n]*$", ""), 1),
        "remove": as_batch(rows.join(toxic, "doc_id", "left_semi"), "delete", F.lit(None).cast("string"), 2),
    }


def op1_token_rollup(spark, sf_dir: str) -> DataFrame:
    """Totals over all documents after the batches of ``feed``, the second of which is sent twice. SQL cannot tokenize; the
    tests compare with a count of the final texts."""
    import public_tokenizers

    rollup = TokenRollup(spark, scratch(spark, "token-rollup"), {"byte_bpe_50k": public_tokenizers.path("byte_bpe_50k.json"), WORDS: None})
    batches = feed(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    for name in ("load", "revise", "revise", "remove"):
        rollup.commit(name, batches[name])
    return rollup.totals()
