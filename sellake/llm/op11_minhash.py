"""Operator 11, MinHash near-dedup: b-bit MinHash.

1. Each row becomes its set of hashed word shingles and ``MINIMA`` minima of it under as many orders. Of each minimum the low ``BITS`` bits are
   kept, packed to a signature of 64 bytes. Before the high bits go, ``BANDS`` bands of ``BAND`` whole minima are hashed to keys.
   Equal sets form one class, and one row stands for it, so copies are never paired.
2. Classes that share a band key are candidates; the rounds and blocks of ``links`` go through them without the pairs of a group.
3. A candidate's likeness is estimated from the count of equal packed values: of ``MINIMA`` values, those of unlike minima are equal once
   in 2**BITS times, so the estimate is (equal / MINIMA - 2**-BITS) / (1 - 2**-BITS). Candidates go on unless so few are equal
   that a pair at the limit would show fewer with probability ``LOST`` only. Families just below the limit pass that in great
   number, so a candidate must also pass the exact parity bound of ``links`` (differing bits are never more than differing shingles).
4. Links are confirmed on the full sets: 100 * intersection >= percent * union. So no wrong link is made; a right one at the very limit
   is missed with probability (1 - t**BAND)**BANDS + LOST (4e-7 at t = 0.85, 2e-6 at 0.8), less where the two
   are joined through others or are more alike.

NULL, empty and wordless texts have no set and link with nothing. Each row is a document of its own, also where ids repeat; a
NULL id counts as the least and stays NULL. A very long text is one set, held whole in one worker; its minima are made a piece
at a time. Only the id and the text are read; other columns may have any names. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, key_back, key_of, read
from .links import Links, folded, may_differ, may_link, mix, named, parity, write_sets

MINIMA, BITS, BANDS, BAND, LOST, PIECE = 128, 4, 25, 5, 1e-9, 4096
#: Multipliers and offsets of the orders: a 32-bit hash x comes at (a x + b) mod 2**32.
_A = (mix(np.arange(1, MINIMA + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (mix(np.arange(1, MINIMA + 1, dtype=np.uint64) << np.uint64(20)) >> np.uint64(32)).astype(np.uint32)


def minima(g: np.ndarray) -> np.ndarray:
    """The least place of the set's members in each order, scrambled so that its low bits depend on all of it."""
    x, least = (g >> np.uint64(12)).astype(np.uint32), np.full(MINIMA, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(x), PIECE):
        least = np.minimum(least, (np.multiply.outer(_A, x[i : i + PIECE]) + _B[:, None]).min(axis=1))
    return (mix(least.astype(np.uint64)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def signature(m: np.ndarray) -> bytes:
    """The low four bits of each minimum, two to a byte."""
    low = (m & np.uint32((1 << BITS) - 1)).astype(np.uint8)
    return (low[::2] | low[1::2] << np.uint8(4)).tobytes()


def bands(m: np.ndarray) -> list[int]:
    """A key for each band of whole minima."""
    key = np.arange(BANDS, dtype=np.uint64)
    for column in m[: BANDS * BAND].astype(np.uint64).reshape(BANDS, BAND).T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64).tolist()


def equal_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many packed values are equal, for rows of signatures."""
    x = a ^ b
    return ((x & np.uint8(15)) == 0).sum(axis=-1, dtype=np.int64) + ((x >> np.uint8(4)) == 0).sum(axis=-1, dtype=np.int64)


def estimate(equal) -> np.ndarray:
    """Likeness, corrected for values that are equal by chance."""
    chance = 2.0**-BITS
    return np.clip((np.asarray(equal) / MINIMA - chance) / (1 - chance), 0, 1)


def fewest_equal(percent: int) -> int:
    """The largest count that a pair at the limit falls short of with probability LOST at most."""
    p, tail, k = percent / 100 + (1 - percent / 100) * 2.0**-BITS, 0.0, 0
    while k <= MINIMA:
        tail += math.comb(MINIMA, k) * p**k * (1 - p) ** (MINIMA - k)
        if tail > LOST:
            return k
        k += 1
    return MINIMA


def _extra(g: np.ndarray) -> dict:
    m = minima(g)
    return {"sig": signature(m) + parity(g), "bands": bands(m) if len(g) else []}


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the least doc_id that links reach) and kept (whether that is its own)."""
    plain = docs.select(key_of(F.col(doc_id).cast("long")).alias("doc"), F.col(text).cast("string").alias("text"))
    rows = write_sets(plain, size, _extra, {"sig": pa.binary(), "bands": pa.list_(pa.int64())}, ", sig binary, bands array<long>")
    linkable = rows.where("n > 0")
    classes = cut(linkable.groupBy("digest").agg(F.min("row").alias("id"), F.min("doc").alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands")), "set-classes")
    fewest = fewest_equal(percent)

    head, bound, bound_fold = MINIMA * BITS // 8, may_link(percent), may_differ(percent)

    def may(sa, sb, na, nb):
        side = lambda s: np.frombuffer(b"".join([x[:head] for x in s]), np.uint8).reshape(len(s), head)
        ok = equal_values(side(sa), side(sb)) >= fewest
        at = np.flatnonzero(ok).tolist()
        ok[at] = bound([sa[i][head:] for i in at], [sb[i][head:] for i in at], na[at], nb[at])
        return ok

    def may_fold(sigs, sig, n, own):
        ok = equal_values(sigs[:, :head], sig[:head]) >= fewest
        ok[ok] = bound_fold(sigs[ok, head:], sig[head:], n[ok], own)
        return ok

    links = Links(linkable, percent, may, lambda s: s[:head] + folded(s[head:]), may_fold)
    component = named(classes, links.spanning(classes.select(F.explode("bands").alias("gram"), "id", "n")))
    out = rows.select("doc", "n", "digest").hint("merge").join(component, "digest", "left")
    least = F.when(F.col("n") > 0, F.coalesce("component", "doc")).otherwise(F.col("doc"))
    return out.select(key_back("doc").alias("doc_id"), F.col("n").alias("n_shingles"), key_back(least).alias("component_id"), (least == F.col("doc")).alias("kept"))


def op11_minhash(spark, sf_dir: str) -> DataFrame:
    """Components of all documents at three-word shingles and a likeness of 0.85."""
    return near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), size=3, percent=85)


# All pairs that share a shingle, and all that links reach; the shingles of a pair are counted in full.
SQL = r"""
WITH RECURSIVE words AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
classes AS MATERIALIZED (SELECT min(rid) AS id, h, any_value(s) AS s, len(any_value(s)) AS n FROM (SELECT rid, s, sha256(array_to_string(list_sort(s), chr(10))) AS h FROM sets WHERE len(s) > 0) GROUP BY h),
grams AS MATERIALIZED (SELECT id, n, hash(unnest(s)) AS g FROM classes),
shared AS (SELECT a.id AS a, b.id AS b, a.n AS na, b.n AS nb, count(*) AS hits FROM grams a JOIN grams b ON a.g = b.g AND a.id < b.id
  AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM shared WHERE 100 * hits >= 85 * (na + nb - hits)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT id AS a, id AS b FROM classes UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
ids AS (SELECT c.id, s.doc_id, s.rid, len(s.s) AS n FROM sets s LEFT JOIN classes c ON c.h = sha256(array_to_string(list_sort(s.s), chr(10))) AND len(s.s) > 0),
least_of AS (SELECT id, bool_or(doc_id IS NULL) AS none, min(doc_id) AS low FROM ids GROUP BY id),
named AS (SELECT r.a AS id, CASE WHEN bool_or(l.none) THEN NULL ELSE min(l.low) END AS component_id FROM reach r JOIN least_of l ON l.id = r.b GROUP BY r.a),
done AS (SELECT i.doc_id, i.n AS n_shingles, CASE WHEN i.n = 0 THEN i.doc_id ELSE n.component_id END AS component_id FROM ids i LEFT JOIN named n USING (id))
SELECT doc_id, n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM done"""
