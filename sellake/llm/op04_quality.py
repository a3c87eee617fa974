"""Operator 4, quality rules: risk-controlled thresholds. DataFrame functions only.

Every document gets counts of its words, symbols, repeated lines and repeated five-word windows. A base rule rejects on fixed
limits. Beyond it, each rule "score above cutoff" is tested on all labelled documents, which no part of the rules is fitted
to: of n good documents that pass the base rule, k are above the cutoff, and the exact binomial tail P(Bin(n, risk) <= k) must be at
most a share of ``delta``.

``fit`` shares delta out among all tests (strata x rules x cutoffs) and the risk among the rules, which needs some 1,570 good labels in
a stratum; below, a rule is off there. The query and the pipeline (``keep_good``) take their cutoffs from ``fit_in_order``: the
union of the rules is tested against the whole ``risk``, along one chain of settings per rule, each stricter than the one before:
from its loosest cutoff to its strictest that rule alone, then the others level by level beside it. The first failure ends a
chain, so delta is divided among the chains ((strata + 1) x rules) and not among cutoffs; some 300 good labels do at 4 strata. Of
the certified settings of a stratum, which hold all at once, the one that rejects most documents labelled bad is used.

Two guarantees hold together with probability 1 - delta. A stratum with enough good labels to pass a test at all loses no more
than ``risk`` of its good documents. The others, also those without any label, take the setting certified on the pooled labels
of all strata: of the good documents of all strata together it rejects no more than ``risk``, as far as labels are drawn evenly from
them. For such a stratum by itself nothing is guaranteed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh, read

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Scores, as whole numbers, and the cutoffs tried for each.
RULES = {
    "symbols_per_100_words": ("100 * n_symbols", "n_words", [5, 10, 20, 30, 40, 60, 100, 200]),
    "repeat_words_percent": ("100 * n_repeat_words", "n_words", [2, 4, 6, 8, 10, 12, 15, 18]),
    "dup_lines_percent": ("100 * n_dup_lines", "n_lines", [10, 15, 20, 25, 30, 40, 50, 60]),
    "word_length_x100": ("100 * word_chars", "n_words", [550, 575, 600, 625, 650, 700, 750, 800]),
}
RISK, DELTA = 0.02, 0.05
#: Cutoffs of a rule, and settings of a chain of ``fit_in_order``.
LEVELS = 8
STEPS = 2 * LEVELS
#: Up to so many strata their cutoffs (some 100 bytes each) are broadcast; beyond, they are joined by Spark's own choice.
MAX_BROADCAST_STRATA = 10_000


def _without(c: Column, chars: str) -> Column:
    for x in chars:
        c = F.replace(c, F.lit(x))
    return c


def add_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and base_failed.

    All of it happens inside the row, so no text is shuffled and a long document costs time in proportion to its words (n log n
    where windows repeat). A NULL text counts as empty: no words, one blank line, rejected by the base rule. A very long text is held
    whole in one task, with arrays of its words and windows. Columns with the names of counts are replaced, all others may have any
    names. An empty table gives no rows; without labels no rule is certified, and the base rule decides alone.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    out = [c for c in docs.columns if c not in _COUNTS]
    _t, _w, _l, _h, _s, _p = fresh(docs, "_t", "_w", "_l", "_h", "_s", "_p")  # helper columns meet no column of the table
    d = docs.select(*out, t.alias(_t))
    d = d.select(*out, _t, F.filter(F.split(_t, SPACE), lambda w: w != F.lit("")).alias(_w),
                 F.filter(F.split(_t, "\n"), lambda x: _without(x, " \t\n\x0b\x0c\r") != F.lit("")).alias(_l))
    d = d.select(
        *out, F.size(_w).cast("long").alias("n_words"),
        F.char_length(_without(F.col(_t), " \t\n\x0b\x0c\r")).cast("long").alias("word_chars"),
        (F.char_length(_t) - F.char_length(_without(F.col(_t), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.char_length(_t) - F.char_length(F.replace(F.col(_t), F.lit("\n"))) + 1).cast("long").alias("n_lines"),
        (F.size(_l) - F.size(F.array_distinct(_l))).cast("long").alias("n_dup_lines"),
        F.transform(_w, lambda w: F.xxhash64(w)).alias(_h),
    )
    last = F.size(_h) - F.lit(WINDOW)
    d = d.withColumn(_h, F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get(_h, i + F.lit(j)) for j in range(WINDOW)]))))
    # windows in order of hash, with their places; only where some window comes twice
    d = d.withColumn(_s, F.when(F.size(F.array_distinct(_h)) < F.size(_h), F.sort_array(F.transform(_h, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    near = lambda x, j: x["h"] == F.get(_s, j)["h"]
    d = d.withColumn(_p, F.sort_array(F.transform(F.filter(_s, lambda x, i: near(x, i - F.lit(1)) | near(x, i + F.lit(1))), lambda x: x["i"])))
    gap = F.transform(_p, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(p - F.get(_p, j - F.lit(1)), F.lit(WINDOW))))
    d = d.withColumn("n_repeat_words", F.coalesce(F.aggregate(gap, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0).cast("long")))
    return d.select(*out, *_COUNTS[:-1], ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"))


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed"]


def _above(rule: str, cutoff) -> Column:
    """Whether the score is above the cutoff, in whole numbers (no division, so no ties by rounding)."""
    top, under, _ = RULES[rule]
    return F.expr(top) > (F.lit(cutoff) if isinstance(cutoff, int) else cutoff) * F.col(under)


def binomial_tail(n: Column, k: Column, risk: float) -> Column:
    """P(Bin(n, risk) <= k), summed in logarithms term by term; 1 where k is not below the mean."""
    from math import log

    odds = log(risk) - log(1 - risk)
    more = F.aggregate(
        F.sequence(F.lit(0).cast("long"), F.least(k, n)), F.struct(F.lit(0.0).alias("term"), F.lit(0.0).alias("all")),
        lambda a, j: F.when(j == 0, a).otherwise(F.struct(
            (a["term"] + F.log((n - j + 1) / F.greatest(j, F.lit(1))) + odds).alias("term"),
            (F.greatest(a["all"], a["term"] + F.log((n - j + 1) / F.greatest(j, F.lit(1))) + odds)
             + F.log1p(F.exp(-F.abs(a["all"] - a["term"] - F.log((n - j + 1) / F.greatest(j, F.lit(1))) - odds)))).alias("all"))),
        lambda a: a["all"])
    return F.when(k < n * F.lit(risk), F.exp(n * F.lit(log(1 - risk)) + more)).otherwise(F.lit(1.0))


def fit(counts: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """``counts`` should be a written table. Cutoffs per stratum: ``stratum`` (text, '' for NULL), one column ``cut_<rule>`` each (NULL: rule off).

    ``counts`` has doc_id, the stratum and the counts. ``labels`` has doc_id and quality; 1 means good. A document with
    several labels is good if one says so; labels without a document, and NULL ones, have no effect. Labels are aggregated
    before anything is gathered, so a stratum may hold any share of the rows.
    """
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    held = counts.where("not base_failed").join(good, "doc_id", "left_semi").withColumn("stratum", _stratum(stratum))
    at = [(r, c) for r, (_, _, cutoffs) in RULES.items() for c in cutoffs]
    sums = held.groupBy("stratum").agg(F.count("*").alias("n"), *[F.sum(_above(r, c).cast("long")).alias(f"{r}__{c}") for r, c in at])
    sums = cut(sums, "quality-counts")  # one row a stratum
    tests = max(1, sums.count()) * len(at)
    picked = {r: [F.when(binomial_tail(F.col("n"), F.col(f"{r}__{c}"), risk / len(RULES)) <= delta / tests, F.lit(c).cast("long")) for c in cutoffs] for r, (_, _, cutoffs) in RULES.items()}
    return sums.select("stratum", *[F.array_min(F.array_compact(F.array(*c))).alias(f"cut_{r}") for r, c in picked.items()])


def _first_step(rule: str) -> Column:
    """The first setting of the rule's chain that rejects the row; STEPS + 1 if none does."""
    n = {r: sum((_above(r, c).cast("long") for c in cutoffs), F.lit(0).cast("long")) for r, (_, _, cutoffs) in RULES.items()}
    alone = F.when(n[rule] > 0, LEVELS + 1 - n[rule]).otherwise(F.lit(STEPS + 1))
    return F.least(alone, *[STEPS + 1 - n[r] for r in RULES if r != rule])


def fit_in_order(counts: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Takes and returns what ``fit`` does, with a row for each stratum of ``counts``; cutoffs tested in a fixed order, pooled
    ones where a stratum is too small (module docstring). A labelled document that no label calls good is bad.

    Each labelled row becomes one step a chain, and rows of a step are counted, so what is held is at most strata x rules x
    (STEPS + 1) rows. The rows rejected up to a step never grow fewer, so the steps that pass are the ones before the first that fails.
    """
    marked = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("long")).alias("good"))
    held = counts.where("not base_failed").join(marked, "doc_id").withColumn("stratum", _stratum(stratum))
    at = F.explode(F.array(*[F.struct(F.lit(-i).alias("chain"), _first_step(r).alias("step")) for i, r in enumerate(RULES)]))
    sums = [F.sum("good").alias("good"), F.sum("bad").alias("bad")]
    own = cut(held.select("stratum", "good", (1 - F.col("good")).alias("bad"), at.alias("at")).groupBy("stratum", "at.chain", "at.step").agg(*sums), "quality-steps")
    limit = delta / ((own.where("good > 0").select("stratum").distinct().count() + 1) * len(RULES))
    pooled = own.groupBy("chain", "step").agg(*sums).select(F.lit(None).cast("string").alias("stratum"), "chain", "step", "good", "bad")
    chain = Window.partitionBy("stratum", "chain")
    tried = own.union(pooled).withColumn("n", F.sum("good").over(chain)).withColumn("k", F.sum("good").over(chain.orderBy("step")))
    tried = tried.withColumn("passed", binomial_tail(F.col("n"), F.col("k"), risk) <= limit)
    ends = tried.where(binomial_tail(F.col("n"), F.lit(0).cast("long"), risk) <= limit).groupBy("stratum", "chain").agg(
        F.coalesce(F.sum(F.when(F.col("passed"), F.col("bad"))), F.lit(0)).alias("caught"), (F.coalesce(F.min(F.when(~F.col("passed"), F.col("step"))), F.lit(STEPS + 1)) - 1).alias("step"))
    best = cut(ends.groupBy("stratum").agg(F.max(F.struct("caught", "chain", "step")).alias("best")), "quality-settings")
    rows = counts.select(_stratum(stratum).alias("stratum")).distinct().join(best, "stratum", "left")
    rows = rows.join(F.broadcast(best.where("stratum is null").select(F.col("best").alias("all"))), F.lit(True), "left").select("stratum", F.coalesce("best", "all").alias("best"))
    level = lambda i: F.when(F.col("best.chain") == -i, F.least(F.col("best.step"), F.lit(LEVELS))).otherwise(F.col("best.step") - LEVELS)
    return rows.select("stratum", *[
        F.when(level(i) > 0, F.get(F.array(*[F.lit(c).cast("long") for c in reversed(cutoffs)]), (level(i) - 1).cast("int"))).alias(f"cut_{r}")
        for i, (r, (_, _, cutoffs)) in enumerate(RULES.items())])


def _stratum(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def judge(counts: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``counts`` with ``kept``. In a stratum without cutoffs the base rule decides alone."""
    side = cutoffs = cut(cutoffs, "quality-cutoffs")
    small = cutoffs.count() <= MAX_BROADCAST_STRATA
    (of,) = fresh(counts, "stratum_of")
    cuts = dict(zip(RULES, fresh(counts, *[f"cut_{r}" for r in RULES])))
    side = side.select(F.col("stratum").alias(of), *[F.col(f"cut_{r}").alias(c) for r, c in cuts.items()])
    joined = counts.withColumn(of, _stratum(stratum)).join(F.broadcast(side) if small else side, of, "left")
    rejected = F.lit(False)
    for r, c in cuts.items():
        rejected = rejected | F.coalesce(_above(r, F.col(c)), F.lit(False))
    # one expression of both sides: a part that is pushed below the join would make the counts once more for each time it names them
    verdict = F.when(F.col("base_failed"), F.lit(False)).otherwise(~rejected)
    return joined.select(*[c for c in counts.columns if c != "kept"], verdict.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the cutoffs of ``fit_in_order``. Counts are made twice, once for the cutoffs and once in the pass that
    filters; that costs less than to write the texts in between, and neither pass shuffles them. Rows without an id, or that share
    one, are judged one by one."""
    cutoffs = fit_in_order(cut(add_counts(docs.select("doc_id", "text", stratum)).select("doc_id", stratum, *_COUNTS), "quality"), labels, stratum)
    counted = add_counts(docs.select(F.struct(*docs.columns).alias("row"), "text", stratum))
    return judge(counted, cutoffs, stratum).where("kept").select("row.*")


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents, with cutoffs from all labels."""
    counts = cut(add_counts(read(spark, sf_dir, "documents", "doc_id", "text", "lang")).select("doc_id", "lang", *_COUNTS), "quality")
    kept = judge(counts, fit_in_order(counts, read(spark, sf_dir, "labels", "doc_id", "quality")))
    return kept.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    levels = {r: " + ".join(f"({top} > {c} * {under})::INT" for c in cutoffs) for r, (top, under, cutoffs) in RULES.items()}
    first = lambda r: f"least(CASE WHEN l_{r} > 0 THEN {LEVELS + 1} - l_{r} ELSE {STEPS + 1} END, " + ", ".join(f"{STEPS + 1} - l_{o}" for o in RULES if o != r) + ")"
    tail = lambda k: f"(SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({RISK}) + (n - j) * ln(1 - {RISK}))) FROM range(0, {k} + 1) AS r(j))"
    return f"""
WITH base AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
parts AS (SELECT *, list_filter(regexp_split_to_array(t, '{SPACE}'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM base),
windows AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM parts WHERE len(w) >= 5)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY rid),
counts AS (SELECT p.doc_id, p.stratum, len(w) AS n_words, length(regexp_replace(t, '{SPACE}', '', 'g')) AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, length(t) - length(replace(t, chr(10), '')) + 1 AS n_lines,
  len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words FROM parts p LEFT JOIN covered c USING (rid)),
levels AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {", ".join(f"{v} AS l_{r}" for r, v in levels.items())} FROM counts),
judged AS MATERIALIZED (SELECT *, [{", ".join(first(r) for r in RULES)}] AS first_steps FROM levels),
marked AS (SELECT doc_id, max((quality = 1)::INT) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
held AS (SELECT stratum, good, unnest(range(0, {len(RULES)})) AS chain, unnest(first_steps) AS step FROM judged JOIN marked USING (doc_id) WHERE NOT base_failed),
own AS MATERIALIZED (SELECT 'of ' || stratum AS body, chain, step, sum(good) AS good, sum(1 - good) AS bad FROM held GROUP BY ALL
  UNION ALL SELECT 'all', chain, step, sum(good), sum(1 - good) FROM held GROUP BY ALL),
share AS (SELECT {DELTA} / (((SELECT count(DISTINCT stratum) FROM held WHERE good > 0) + 1) * {len(RULES)}) AS most),
tried AS (SELECT *, (sum(good) OVER (PARTITION BY body, chain))::BIGINT AS n, (sum(good) OVER (PARTITION BY body, chain ORDER BY step))::BIGINT AS k FROM own),
tested AS MATERIALIZED (SELECT *, k < n * {RISK} AND CASE WHEN k < n * {RISK} THEN {tail("k")} ELSE 1 END <= most AS passed, n > 0 AND {tail("0")} <= most AS enough FROM tried, share),
ends AS (SELECT body, chain, coalesce(sum(bad) FILTER (passed), 0) AS caught, coalesce(min(step) FILTER (NOT passed), {STEPS + 1}) - 1 AS step FROM tested WHERE enough GROUP BY body, chain),
best AS (SELECT body, chain, step FROM ends QUALIFY row_number() OVER (PARTITION BY body ORDER BY caught DESC, chain, step DESC) = 1),
used AS (SELECT stratum, coalesce(o.chain, a.chain) AS chain, coalesce(o.step, a.step) AS step FROM (SELECT DISTINCT stratum FROM judged)
  LEFT JOIN best o ON o.body = 'of ' || stratum LEFT JOIN best a ON a.body = 'all')
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(first_steps[chain + 1] <= step, false) AS kept
FROM judged JOIN used USING (stratum)"""


SQL = _sql()
