"""Operator 12, filter interaction audit: exact constrained least squares over coalitions of filters.

1. Each document becomes a mask: bit i is set where it fails filter i. Only masks, ids and digests leave the row.
2. Documents are counted by part, mask and label. A coalition S of filters removes the documents whose mask meets S, so the 32
   coalition removals of a part are sums of its 32 mask counts, whatever its number of documents.
3. The Shapley values are the weights of the best linear model of the removals: least squares over all proper coalitions with
   the kernel weights (M-1) / (C(M,s) s (M-s)), under the constraint that the values sum to what all filters together remove.
   The constrained normal equations are solved in rationals, so the result is exact: times M! it is the sum over all orders.
4. A filter f that comes after the coalition P removes v(P + f) - v(P); so all steps of all M! orders are coalition differences.

NULL and empty texts have no words. A document is a repeat where an equal text (NULL equals empty) has a smaller id: rows that
share both text and least id are none, and a row without an id neither is a repeat nor makes one. A label holds for all rows
of its id, once, if any row of ``labels`` says so; labels without an id or a document have no effect. An empty table gives no
rows. Texts are read whole, one at a time; a very long text costs one list of its words. Of ``docs`` only the three named
columns are used, so other columns may have any names. Groups of equal texts and parts of any size are counted map-side first
and joined on (digest, id), so none lands in one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, read

FILTERS = "ABCDE"
_SYMBOL, _UPPER = re.compile(rb"[#$%&*|]"), re.compile(rb"[^A-Z]+")


def text_mask(text: bytes) -> int:
    """Failures of the filters that look at the text alone: bits 0 to 3 for A to D."""
    words = text.split()  # of bytes: white space is \x20 \x09-\x0D
    chars = len(text.decode("utf-8", "replace"))
    return ((len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1
            | (100 * len(_UPPER.sub(b"", text)) > 3 * chars) << 2 | (_SYMBOL.search(text) is not None) << 3)


def failures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang", mask_of: Callable[[bytes], int] = text_mask, repeat_bit: int = 4) -> DataFrame:
    """(doc_id, part, mask) per row of ``docs``; ``mask_of`` gives the bits of a text, ``repeat_bit`` is set for repeated texts."""

    def masks(batches):
        for b in batches:
            found, digests = [], []
            for t in b.column(2).cast(pa.binary()):
                raw = t.as_py() or b""
                found.append(mask_of(raw))
                digests.append(hashlib.sha256(raw).digest())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.int32()), pa.array(digests, pa.binary())], names=["doc_id", "part", "mask", "digest"])

    plain = docs.select(F.col(doc_id).cast("long"), F.coalesce(F.col(part).cast("string"), F.lit("")), F.col(text).cast("string"))
    rows = cut(plain.mapInArrow(masks, "doc_id long, part string, mask int, digest binary"), "filter-masks")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").withColumn("is_first", F.lit(True))
    joined = rows.hint("merge").join(first, ["digest", "doc_id"], "left")
    repeated = F.col("is_first").isNull() & F.col("doc_id").isNotNull()
    return joined.select("doc_id", "part", F.when(repeated, F.col("mask").bitwiseOR(1 << repeat_bit)).otherwise(F.col("mask")).alias("mask"))


def mask_counts(failed: DataFrame, labels: DataFrame, filters: int = len(FILTERS)) -> DataFrame:
    """One row per part: ``n``, ``good`` and ``toxic``, arrays of 2**filters counts by mask. ``labels``: doc_id, quality, toxic."""
    says = lambda c: F.max((F.coalesce(F.col(c).cast("long"), F.lit(0)) == 1).cast("long"))
    marked = labels.where("doc_id is not null").groupBy("doc_id").agg(says("quality").alias("good"), says("toxic").alias("toxic"))
    rows = failed.hint("merge").join(marked, "doc_id", "left")
    sums = [F.sum(F.coalesce(c, F.lit(0))).alias(name) for c, name in ((F.lit(1).cast("long"), "n"), (F.col("good"), "good"), (F.col("toxic"), "toxic"))]
    counted = rows.groupBy("part", "mask").agg(*sums)
    at = lambda c: F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0)).cast("long") for m in range(1 << filters)]).alias(c)
    return counted.groupBy("part").agg(at("n"), at("good"), at("toxic"))


def removals(by_mask: list[int]) -> list[int]:
    """Documents that each coalition removes, from counts by mask."""
    return [sum(c for mask, c in enumerate(by_mask) if mask & s) for s in range(len(by_mask))]


def solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """The solution of a regular system, by elimination in rationals."""
    rows, n = [[*r, b] for r, b in zip(matrix, right)], len(right)
    for i in range(n):
        pivot = next(k for k in range(i, n) if rows[k][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for k in range(n):
            if k != i and rows[k][i]:
                rows[k] = [x - rows[k][i] * y for x, y in zip(rows[k], rows[i])]
    return [r[n] for r in rows]


def shapley(v: list[int]) -> list[Fraction]:
    """Shapley value of each filter from the 2**m removals ``v``, ``v[0]`` being 0: minimise the weighted squares of
    v(S) - sum of phi over S, subject to sum(phi) = v(all); the last unknown is the multiplier of that constraint."""
    m = len(v).bit_length() - 1
    if m == 1:
        return [Fraction(v[1])]
    matrix, right = [[Fraction(0)] * (m + 1) for _ in range(m + 1)], [Fraction(0)] * m + [Fraction(v[-1])]
    for s in range(1, len(v) - 1):
        size, inside = s.bit_count(), [i for i in range(m) if s >> i & 1]
        weight = Fraction(m - 1, comb(m, size) * size * (m - size))
        for i in inside:
            right[i] += weight * v[s]
            for j in inside:
                matrix[i][j] += weight
    for i in range(m):
        matrix[i][m] = matrix[m][i] = Fraction(1)
    return solve(matrix, right)[:m]


def audit(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """Every step of every order of the filters, per part, from ``mask_counts``: see the module docstring."""
    m = len(names)
    columns = {"part": pa.string(), "filter_order": pa.string(), "step": pa.int32()} | {c: pa.int64() for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")}

    def steps(batches):
        for b in batches:
            for row in b.to_pylist():
                v, good, toxic = (removals(row[c]) for c in ("n", "good", "toxic"))
                total, everyone = sum(row["n"]), len(v) - 1
                value = [x * factorial(m) for x in shapley(v)]
                out = {c: [] for c in columns}
                for order in permutations(range(m)):
                    before, name = 0, "".join(names[i] for i in order)
                    for step, i in enumerate(order, 1):
                        after = before | 1 << i
                        removed = v[after] - v[before]
                        for c, x in zip(columns, (row["part"], name, step, total - v[after], removed, v[1 << i] - removed, v[everyone] - v[everyone ^ 1 << i],
                                                  good[after] - good[before], toxic[after] - toxic[before], value[i].numerator)):
                            out[c].append(x)
                        before = after
                yield pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in columns.items()], names=list(columns))

    schema = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
    return counts.mapInArrow(steps, schema)


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    """All orders of the five filters over all documents, by language."""
    failed = failures(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return audit(cut(mask_counts(failed, read(spark, sf_dir, "labels", "doc_id", "quality", "toxic")), "filter-counts"))


# The SQL counts each step from the documents' flags and adds up the orders, without coalitions or equations.
SQL = r"""
WITH firsts AS MATERIALIZED (SELECT sha256(coalesce(text, '')) AS h, min(doc_id) AS first_id FROM documents GROUP BY 1),
worded AS MATERIALIZED (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
flags AS MATERIALIZED (SELECT d.part, d.doc_id, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
  100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 3 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d, coalesce(d.doc_id > f.first_id, false) AS e
  FROM worded d JOIN firsts f ON f.h = sha256(d.t)),
marked AS (SELECT doc_id, max(quality = 1)::INT AS good, max(toxic = 1)::INT AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
grouped AS MATERIALIZED (SELECT part, a, b, c, d, e, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM flags LEFT JOIN marked USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (SELECT p.f || q.f || r.f || s.f || t.f AS filter_order FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5),
steps AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
tried AS (SELECT part, filter_order, step, n, good, toxic, filter_order[step] AS f,
  list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: CASE x WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END) AS fails FROM grouped, steps),
placed AS (SELECT *, list_contains(fails, f) AS here, len(list_filter(fails, lambda x: instr(filter_order, x) < step)) > 0 AS earlier FROM tried),
counted AS (SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT here AND NOT earlier), 0) AS kept, coalesce(sum(n) FILTER (here AND NOT earlier), 0) AS removed,
  coalesce(sum(n) FILTER (here AND earlier), 0) AS redundant, coalesce(sum(n) FILTER (here AND len(fails) = 1), 0) AS unique_fails,
  coalesce(sum(good) FILTER (here AND NOT earlier), 0) AS good_lost, coalesce(sum(toxic) FILTER (here AND NOT earlier), 0) AS toxic_lost FROM placed GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM counted"""
