"""Operator 3, document fingerprints: consistent weighted sampling. DataFrame functions only.

A document's terms are its words in lower case, weighted by their counts. For each sample and each term, hashes of both give
r and c of Gamma(2, 1) and b uniform; with t = floor(ln w / r + b) the term's value is ln c - r (t - b) - r, and the
sample is the least value over the terms. Two documents share it with the probability of their generalised Jaccard
similarity, sum of least over sum of greatest weights.

The least value itself tells term and t, so a sample is a minimum of doubles: no term is carried along, and the minima of a
document are partial aggregates where its words are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, key_back, key_of, read

SAMPLES, AT_ONCE = 64, 8
SPACE = r"[\x20\x09-\x0D]+"


def _uniform(bits: Column) -> Column:
    """32 bits as a number in (0, 1)."""
    return (bits.cast("double") + 0.5) / float(1 << 32)


def _value(h: Column, sample: Column) -> tuple[Column, Column, Column]:
    """r, ln c and b of a term's hash and a sample."""
    a, b, c = (F.xxhash64(h, sample * 3 + i) for i in range(3))
    high, low = lambda x: _uniform(F.shiftrightunsigned(x, 32)), lambda x: _uniform(x.bitwiseAND(0xFFFFFFFF))
    return -F.log(high(a) * low(a)), F.log(-F.log(high(b) * low(b))), high(c)


def signatures(texts: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per ``key`` (unique) and for each text column an array ``<column>_sig`` of SAMPLES 16-bit hashes of its samples; NULL
    where it has no word. ``texts`` should be partitioned by ``key``: then words are counted and sampled without a shuffle."""
    one = F.explode(F.array(*[F.struct(*[F.lit(int(i == j)).cast("long").alias(f"w{j}") for j in range(len(columns))], F.split(F.lower(c), SPACE).alias("words")) for i, c in enumerate(columns)]))
    words = texts.select(key, one.alias("x")).select(key, *[f"x.w{j}" for j in range(len(columns))], F.explode("x.words").alias("word")).where("word <> ''")
    counts = words.groupBy(key, F.xxhash64("word").alias("h")).agg(*[F.sum(f"w{j}").alias(f"w{j}") for j in range(len(columns))])
    lots = counts.select(key, "h", *[F.log(f"w{j}").alias(f"w{j}") for j in range(len(columns))], F.explode(F.sequence(F.lit(0), F.lit(SAMPLES // AT_ONCE - 1))).alias("lot"))
    mins = []
    for i in range(AT_ONCE):
        r, lc, b = _value(F.col("h"), F.col("lot") * AT_ONCE + i)
        for j in range(len(columns)):  # a weight of 0 has a NULL logarithm, so the term is not there
            mins.append(F.min(lc - r * (F.floor(F.col(f"w{j}") / r + b) - b) - r).alias(f"m{j}_{i}"))
    least = lots.groupBy(key, "lot").agg(*mins)
    code = lambda c: F.when(F.col(c).isNotNull(), F.xxhash64(c).bitwiseAND(0xFFFF)).cast("int")
    sides = [F.struct("lot", F.array(*[code(f"m{j}_{i}") for i in range(AT_ONCE)]).alias("s")) for j in range(len(columns))]
    rows = least.groupBy(key).agg(*[F.sort_array(F.collect_list(s)).alias(f"s{j}") for j, s in enumerate(sides)])
    return rows.select(key, *[F.when(F.get(F.get(F.col(f"s{j}"), F.lit(0))["s"], F.lit(0)).isNotNull(), F.flatten(F.col(f"s{j}")["s"])).alias(f"{c}_sig") for j, c in enumerate(columns)])


def likeness(a: str, b: str) -> Column:
    """Share of equal samples; 1 for two documents without words, 0 for one."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(float(SAMPLES))
    return F.when(F.col(a).isNull() | F.col(b).isNull(), (F.col(a).isNull() & F.col(b).isNull()).cast("double")).otherwise(same)


def as_text(sig: str) -> Column:
    """Four hexadecimal digits a sample; only f without words."""
    return F.coalesce(F.array_join(F.transform(sig, lambda x: F.lpad(F.lower(F.hex(x)), 4, "0")), ""), F.lit("f" * 4 * SAMPLES))


def next_of(ids: DataFrame) -> DataFrame:
    """(key, n, next) of rows (key, n): the next key in ascending order, after the last the first. Ids alone are sorted, in
    ranges; the first key of each range is one row a partition."""
    ranged = cut(ids.repartitionByRange("key").withColumn("range", F.spark_partition_id()), "id-ranges")
    firsts = ranged.groupBy("range").agg(F.min("key").alias("first"))
    order = Window.orderBy("range")
    firsts = firsts.select("range", F.coalesce(F.lead("first").over(order), F.min("first").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    within = ranged.withColumn("next", F.lead("key").over(Window.partitionBy("range").orderBy("key")))
    return within.join(F.broadcast(cut(firsts, "range-firsts")), "range").select("key", "n", F.coalesce("next", "after").alias("next"))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of all documents and of their edited texts, in which the last quarter (floor) of the code points is
    replaced by as many from the start of the next document in ascending id, or all of it; the first follows the last.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next. NULL and empty texts
    have no terms: their fingerprint is all f, like only to such another. Of rows that repeat an id the least text counts; a NULL
    id comes first. One document follows itself. An empty table gives no rows. A very long text is one row of terms, and its terms
    are rows of their own before they meet. Only the id and the text are read, so other columns may have any names.
    """
    rows = docs.select(key_of(F.col(doc_id).cast("long")).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    ids = cut(rows.select("key", F.char_length("text").cast("long").alias("n")), "ids")
    if ids.groupBy("key").count().where("count > 1").limit(1).count():
        rows = rows.groupBy("key").agg(F.min("text").alias("text"))
        ids = cut(rows.select("key", F.char_length("text").cast("long").alias("n")), "ids")
    order = cut(next_of(ids), "id-order")
    # each document's start moves to the one before it
    before = order.select(F.col("next").alias("key"), F.col("key").alias("to"), F.floor(F.col("n") / 4).cast("int").alias("take"))
    placed = rows.join(before, "key")
    heads = placed.select(F.col("to").alias("key"), F.substring("text", F.lit(1), F.col("take")).alias("head"))
    quarter = F.floor(F.char_length("text") / 4).cast("int")
    edited = placed.select("key", "text").join(heads, "key").select("key", "text", F.concat(F.substring("text", F.lit(1), F.char_length("text") - quarter), "head").alias("edited"))
    facts = edited.select("key", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    made = cut(facts.join(signatures(edited, "key", ["text", "edited"]), "key", "left"), "signatures")
    after = made.select(F.col("key").alias("next"), F.col("text_sig").alias("next_sig"))
    return made.join(order.select("key", "next"), "key").join(after, "next").select(
        key_back("key").alias("doc_id"), "n_chars", "edited_sha256", as_text("text_sig").alias("fingerprint"), as_text("edited_sig").alias("edited_fingerprint"),
        likeness("text_sig", "edited_sig").alias("near_edited"), likeness("text_sig", "next_sig").alias("near_next"))


def op3_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents; SQL draws other hashes, so the tests compare with exact generalised Jaccard."""
    return fingerprints(read(spark, sf_dir, "documents", "doc_id", "text"))
