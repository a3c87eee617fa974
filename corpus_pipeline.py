"""The training-corpus pipeline over ``documents``: quality rules, language ID, line dedup, n-gram join, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as Parquet to the shared folder
and reads it again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sellake.llm.common import cut, read
from sellake.llm.op04_quality import keep_good
from sellake.llm.op05_line_dedup import dedup_lines
from sellake.llm.op06_ngram_join import keep_one
from sellake.llm.op09_language import keep_known
from sellake.llm.op10_packing import packed_documents

#: Lines of so many documents are repeated ones; the first of them stays.
LINE_DOCS = 10
#: A line of more words than this is a repeated one in two documents already, once near copies are gone.
LONG_WORDS = 50
SHINGLE, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the cutoffs learned from ``labels``."""
    return keep_good(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told apart; texts without letters and narrow margins go."""
    return keep_known(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; a line of ten documents or more stays in the first of them only."""
    return _counted(dedup_lines(docs, min_docs=LINE_DOCS, keep="first"), docs.columns)


def _counted(clean: DataFrame, columns: list[str]) -> DataFrame:
    return clean.select(*[F.char_length("text").cast("long").alias(c) if c == "n_chars" else c for c in columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked ones: five-word shingles, likeness 0.8 or more. Then a long line that two
    documents or more still share stays in the first of them only; done before, that would leave rests of near copies, which
    link with nothing any more."""
    one = cut(keep_one(docs, SHINGLE, PERCENT), "one-each")
    return _counted(dedup_lines(one, min_docs=2, min_chars=2 * LONG_WORDS + 1, keep="first", min_words=LONG_WORDS + 1), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per packed sequence. A worker remembers fewer chunks than by itself, as the stages before have had their share of memory."""
    return packed_documents(spark, docs, entries=250_000)


STAGES = [
    ("quality rules", quality),
    ("language ID", language),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("packing", packing),
]
#: SQL has no zstandard and no tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
