"""Operator 9, language identification: compression with a zstandard raw-content dictionary per language.

A text's letters, in lower case and with one space for all else, are compressed in blocks with each language's dictionary;
the language whose dictionary gives the fewest bytes over all blocks wins. Where the second best is hardly larger, the
document is rejected.

Learning uses a bounded sample, which is a parameter: per language the ``SAMPLE_ROWS`` distinct texts of least hash, at most
``SAMPLE_CHARS`` code points of each and ``DICT_BYTES`` bytes in all. The languages are counted over all labelled rows; more
than ``MAX_LANGUAGES`` is an error, as each text is compressed once for each. Prediction reads every whole text.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, read

DICT_BYTES, SAMPLE_ROWS, SAMPLE_CHARS, MAX_LANGUAGES = 96 << 10, 400, 500, 200
BLOCK = 4096
#: zstandard's lazy matcher with matches from four bytes on tells languages apart better than the levels, which skip short ones.
ZSTD = {"strategy": 4, "min_match": 4, "window_log": 18, "hash_log": 16, "chain_log": 16, "search_log": 4, "target_length": 32}
#: A prediction is rejected where the best size is not smaller than the second best by this share.
MIN_MARGIN = 0.004
UNKNOWN = "und"


def letters(text) -> F.Column:
    """Letters in lower case, one space for each run of anything else."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"\P{L}+", " "))


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Raw dictionary content per language, from rows with a language and a letter. Equal texts count once, so a large group
    of copies fills no dictionary; a text of two languages counts for both. No labelled row: no language."""
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.xxhash64(text).alias("h"), letters(F.col(text)).alias("t")).where("lang is not null and t <> ''")
    hashes = cut(rows.select("lang", "h"), "lang-hashes").distinct()
    if (n := hashes.select("lang").distinct().count()) > MAX_LANGUAGES:
        raise ValueError(f"{n} languages; at most {MAX_LANGUAGES}")
    # first within parts of a language, as one language may hold most rows
    least = lambda df, *by: df.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy("h"))).where(F.col("n") <= SAMPLE_ROWS).drop("n")
    picked = least(least(hashes.withColumn("part", F.pmod("h", F.lit(64))), "lang", "part").drop("part"), "lang")
    picked = cut(picked, "lang-sample")
    # at most MAX_LANGUAGES * SAMPLE_ROWS hashes
    sample = rows.join(F.broadcast(picked), ["lang", "h"], "left_semi").groupBy("lang", "h").agg(F.min(F.substring("t", 1, SAMPLE_CHARS)).alias("t"))
    out: dict[str, bytes] = {}
    for r in sorted(sample.collect(), key=lambda r: (r.lang, r.h)):
        have = out.get(r.lang, b"")
        if len(have) < DICT_BYTES:
            out[r.lang] = (have + b" " + r.t.encode())[:DICT_BYTES]
    return out


class _Compressors:
    """One compressor a language, made once in a worker."""

    _made: dict = {}

    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard as z

        self.by_lang = []
        for lang in sorted(dictionaries):
            d = z.ZstdCompressionDict(dictionaries[lang], dict_type=z.DICT_TYPE_RAWCONTENT)
            how = z.ZstdCompressionParameters(write_content_size=0, write_dict_id=0, **ZSTD)
            d.precompute_compress(compression_params=how)
            self.by_lang.append((lang, z.ZstdCompressor(dict_data=d, compression_params=how)))

    @classmethod
    def of(cls, key, dictionaries):
        if key not in cls._made:
            cls._made.clear()
            cls._made[key] = cls(dictionaries)
        return cls._made[key]

    def __call__(self, text: str) -> tuple[str, float, bool]:
        if not text or not self.by_lang:
            return UNKNOWN, 0.0, False
        raw = text.encode()
        blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
        sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in self.by_lang)
        if len(sizes) == 1:
            return sizes[0][1], 1.0, True
        margin = 1.0 - sizes[0][0] / sizes[1][0]
        return sizes[0][1], margin, margin >= MIN_MARGIN


def predict(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (share by which the best size is below the second best) and accepted.

    NULL, empty and letterless texts are ``und`` with score 0, not accepted. Ties go to the first language by name, with score
    0, not accepted. Columns of these names in ``docs`` are replaced.
    """
    import uuid

    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "accepted")]
    shared, key = docs.sparkSession.sparkContext.broadcast(dictionaries), uuid.uuid4().hex

    def classify(batches):
        classifier = _Compressors.of(key, shared.value)
        for b in batches:
            got = [classifier(t.as_py()) for t in b.column("__letters")]
            cols = [b.column(c) for c in keep] + [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "lang_pred", "score", "accepted"])

    out = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())]
    return docs.select(*keep, letters(F.col(text)).alias("__letters")).mapInArrow(classify, T.StructType([*docs.select(*keep).schema, *out]))


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is told apart, learned from the rows that are not held out."""
    model = learn(docs.where(~held_out() & F.col("doc_id").isNotNull()))
    return predict(docs.select(F.struct(*docs.columns).alias("row"), "text"), model).where("accepted").select("row.*")


def op9_language(spark, sf_dir: str) -> DataFrame:
    """Languages of all documents; SQL has no zstandard, so the tests measure held-out accuracy."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = learn(docs.where(~held_out() & F.col("doc_id").isNotNull()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score", "accepted")
