"""Operator 13, hard-negative mining: anchor-clustered shared lists (in the manner of MAXIMUS).

1. Components become whole numbers, floor(256 x), so every score is an exact integer inner product.
2. Centres of the anchors' directions are fitted on at most ``SAMPLE`` anchors (spherical k-means, at most ``CENTRES`` centres). All
   anchors and all candidates are then dealt to their nearest centre; candidates are written to one folder per cell.
3. Anchors of one centre are cut into groups of some ``GROUP`` members. A group has a radius r, the largest angle of a member to the
   centre. For a candidate at angle t to the centre, no member u scores more than |u| |x| cos(max(0, t - r)): the angular bound.
   The group's list is sorted by it once, cell by cell (largest bound of a cell first) and block by block within a cell, and all members share it.
4. Every member walks that list until it is certified that nothing further down can enter its results: its bound there is
   below the score of its worst result. Equal scores never end a walk, as the smaller id comes first. The first walk
   finds the positives, the second, with their scores known, the negatives of each. A cell whose bound ends all walks is not read.

A task holds one group, its results and one block of candidates, so memory is bounded whatever a cell or a cluster holds; the list
itself is never made as rows, and candidates are read from the shared folder, so a lost executor's group is walked again.

Defined results: rows with a NULL label, a NULL vector or a component that is NULL or not finite take no part. A vector without
components, or of zeros, scores 0 with all; missing components of a shorter vector count as 0. Each row is a candidate of its own,
also where ids repeat; a NULL id is no anchor, comes first among equal scores and stays NULL. Scores beyond 64 bits raise an
error. An empty table, or one without anchors, gives no rows. Only the named columns are read, so others may have any names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, key_back, key_of, open_fs, read, scratch

#: Anchors that centres are fitted on, and centres, at most; members of a group and rows of a folder's file, about; rows of a block.
SAMPLE, CENTRES, GROUP, FILE_ROWS, BLOCK = 8192, 1024, 512, 100_000, 8192
SCALE = 256
#: Room for rounding in angles and bounds: candidates within it are looked at.
SLACK = 1e-6
_ROWS = "key long, id long, label long, anchor boolean, vector array<long>"


def prepared(rows: DataFrame, vec_id: str, vector: str, label: str | Column, anchor: Column) -> DataFrame:
    """(key, id, label, anchor, vector) of the rows that take part, written; ``key`` is the row's own number."""
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    whole = F.transform(x, lambda v: F.floor(v * SCALE))
    kept = rows.where(x.isNotNull() & ~bad).select(
        key_of(F.col(vec_id).cast("long")).alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
        (F.col(vec_id).isNotNull() & F.coalesce(anchor, F.lit(False))).alias("anchor"), whole.alias("vector")).where("label is not null")
    return cut(kept.select(F.monotonically_increasing_id().alias("key"), "*"), "vectors", _ROWS)


def matrix(column, d: int) -> np.ndarray:
    """An Arrow column of lists as a matrix of ``d`` columns, short rows filled up with 0."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = lists.offsets.to_numpy()
    lens, flat = np.diff(ends), lists.flatten().to_numpy(zero_copy_only=False)
    if len(lens) and (lens == d).all():
        return flat.reshape(-1, d)
    out = np.zeros((len(lens), d), np.int64)
    out[np.repeat(np.arange(len(lens)), lens), np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], lens)] = flat
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two whole-number matrices."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2.0**63:
        return a @ b.T
    big = a.astype(object) @ b.astype(object).T
    if big.size and max(abs(int(v)) for v in big.ravel()) >= 2**63:
        raise ArithmeticError("a score does not fit 64 bits")
    return big.astype(np.int64)


def directions(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (zeros stay) and lengths of the rows."""
    x = m.astype(np.float64)
    top = np.abs(x).max(axis=1, initial=0)
    lengths = top * np.sqrt(((x / np.where(top > 0, top, 1)[:, None]) ** 2).sum(axis=1))
    return x / np.where(lengths > 0, lengths, 1)[:, None], lengths


def angles(units: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centre, -1, 1))


def fit_centres(anchors: DataFrame, total: int, d: int) -> np.ndarray:
    """Unit centres (at most CENTRES) from at most SAMPLE anchors, those of least hash; the same every time."""
    some = anchors.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("vector").toArrow()
    x, lengths = directions(matrix(some.column(0), d))
    x = x[lengths > 0]
    k = min(CENTRES, math.ceil(math.sqrt(total)), max(1, len(x) // 4))
    if not len(x):
        return np.eye(1, max(1, d))
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(8):
        near = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        new, lengths = directions(sums)
        centres = np.where(lengths[:, None] > 0, new, centres)
    return centres


def _dealt(rows: DataFrame, centres, d: int) -> DataFrame:
    """``rows`` with its cell, the angle to the cell's centre and the length of the vector."""

    def deal(batches):
        for b in batches:
            for i in range(0, b.num_rows, BLOCK):
                part = b.slice(i, BLOCK)
                x, lengths = directions(matrix(part.column("vector"), d))
                near = x @ centres.value.T
                cell = near.argmax(axis=1)
                angle = np.arccos(np.clip(near[np.arange(len(cell)), cell], -1, 1))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell, pa.int32()), pa.array(angle, pa.float64()), pa.array(lengths, pa.float64())],
                                                 names=[*part.schema.names, "cell", "angle", "length"])

    return rows.mapInArrow(deal, _ROWS + ", cell int, angle double, length double")


class Cells:
    """The candidates on disk, by cell: smallest and largest angle to the cell's centre, largest length. At most CENTRES entries."""

    def __init__(self, path: str, centres: np.ndarray, stats: list, d: int):
        self.path, self.centres, self.d = path, centres, d
        self.cells = np.array([r.cell for r in stats], int)
        self.low, self.high, self.length = (np.array([r[c] for r in stats], float) for c in ("low", "high", "length"))

    def in_order(self, centre: np.ndarray, radius: float):
        """(cell, bound) by falling bound of what a member of length 1 can score there."""
        apart = angles(self.centres[self.cells], centre)
        nearest = np.maximum(0, np.maximum(apart - self.high, self.low - apart))
        bound = self.length * np.cos(np.maximum(0, nearest - radius - SLACK))
        for i in np.argsort(-bound, kind="stable"):
            yield int(self.cells[i]), float(bound[i])

    def blocks(self, cell: int):
        import pyarrow.dataset as ds

        fs, inner = open_fs(f"{self.path}/cell={cell}")
        for b in ds.dataset(inner, filesystem=fs, format="parquet").to_batches(columns=["key", "id", "label", "vector", "length"], batch_size=BLOCK, batch_readahead=1, fragment_readahead=1):
            if b.num_rows:
                yield b


def write_cells(dealt: DataFrame, centres: np.ndarray, d: int) -> Cells:
    path = scratch(dealt.sparkSession, "candidate-cells")
    stats = dealt.groupBy("cell").agg(F.min("angle").alias("low"), F.max("angle").alias("high"), F.max("length").alias("length"), F.count("*").alias("n"))
    found = stats.orderBy("cell").collect()  # one row a centre
    parts = F.create_map(*[F.lit(x) for r in found for x in (r.cell, -(-r.n // FILE_ROWS))]) if found else F.create_map(F.lit(0), F.lit(1))
    salted = dealt.withColumn("salt", F.pmod(F.xxhash64("key"), parts[F.col("cell")]))
    salted.repartition("cell", "salt").select("key", "id", "label", "vector", "length", "cell").write.partitionBy("cell").parquet(path)
    return Cells(path, centres, found, d)


class Best:
    """The best ``k`` of each of ``n`` lists: higher score first, then the smaller id. Rows may come in any order."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score, self.id = np.full((n, k), np.iinfo(np.int64).min), np.full((n, k), np.iinfo(np.int64).max)
        self.filled = np.zeros(n, int)

    def worst(self) -> np.ndarray:
        """The score that a newcomer must reach."""
        return np.where(self.filled == self.k, self.score[:, -1], np.iinfo(np.int64).min)

    def add(self, which: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(which):
            return
        old = np.unique(which)
        keep = np.arange(self.k)[None, :] < self.filled[old][:, None]
        which = np.concatenate([np.repeat(old, self.filled[old]), which])
        score, ids = np.concatenate([self.score[old][keep], score]), np.concatenate([self.id[old][keep], ids])
        order = np.lexsort((ids, -score, which))
        which, score, ids = which[order], score[order], ids[order]
        place = np.arange(len(which)) - np.searchsorted(which, which)
        top = place < self.k
        self.score[which[top], place[top]], self.id[which[top], place[top]] = score[top], ids[top]
        self.filled[old] = np.minimum(self.k, np.bincount(which, minlength=len(self.filled))[old])


def walk(cells: Cells, members: np.ndarray, lengths: np.ndarray, centre: np.ndarray, radius: float, floor, take, step: int = 1024) -> None:
    """All members walk the group's list. ``floor()`` gives what each still needs to score; ``take`` gets members, rows and scores."""
    needed = floor()
    for cell, most in cells.in_order(centre, radius):
        if not (lengths * most * (1 + SLACK) + SLACK >= needed).any():
            return
        for block in cells.blocks(cell):
            vectors, length = matrix(block.column("vector"), cells.d), block.column("length").to_numpy()
            units = vectors / np.where(length > 0, length, 1)[:, None]
            bound = length * np.cos(np.maximum(0, angles(units, centre) - radius - SLACK))
            order = np.argsort(-bound, kind="stable")
            keys, ids, labels = (block.column(c).to_numpy()[order] for c in ("key", "id", "label"))
            vectors, bound = vectors[order], bound[order]
            for i in range(0, len(order), step):
                going = np.flatnonzero(lengths * bound[i] * (1 + SLACK) + SLACK >= needed)
                if not len(going):
                    break  # the rest of this block is certified for all; later blocks have their own bounds
                to = slice(i, i + step)
                take(going, keys[to], ids[to], labels[to], scores(members[going], vectors[to]))
                needed = floor()


def mine(cells: Cells, keys, labels, vectors, centre, radius, positives: int, negatives: int, low: int, high: int):
    """(member, positive's place, positive's id and score, rank, negative's id and score) for the members of a group."""
    n, least = len(keys), np.iinfo(np.int64).min
    _, lengths = directions(vectors)
    best = Best(n, positives)

    def positive(going, k, ids, lab, s):
        ok = (lab[None, :] == labels[going][:, None]) & (k[None, :] != keys[going][:, None]) & (s >= best.worst()[going][:, None])
        a, b = np.nonzero(ok)
        best.add(going[a], s[a, b], ids[b])

    walk(cells, vectors, lengths, centre, radius, lambda: best.worst().astype(float), positive)
    # a list for each positive, numbered member * positives + place; only scores of low to high percent of the positive's enter
    there = np.arange(positives)[None, :] < best.filled[:, None]
    top = np.where(there, best.score, 0)
    exact = top.astype(object)
    ceiling, ground = (high * exact // 100).astype(np.int64), (-(-low * exact // 100)).astype(np.int64)
    there &= ground <= ceiling
    found = Best(n * positives, negatives)

    def floor():
        each = np.maximum(found.worst().reshape(n, positives), ground).astype(float)
        return np.where(there, each, np.inf).min(axis=1, initial=np.inf)

    def negative(going, k, ids, lab, s):
        other = lab[None, :] != labels[going][:, None]
        worst = found.worst().reshape(n, positives)
        for j in range(positives):
            from_, to = np.maximum(worst[going, j], ground[going, j]), ceiling[going, j]
            a, b = np.nonzero(other & (s >= from_[:, None]) & (s <= to[:, None]) & there[going, j][:, None])
            found.add(going[a] * positives + j, s[a, b], ids[b])

    walk(cells, vectors, lengths, centre, radius, floor, negative)
    for m, place in zip(*np.nonzero(there)):
        at = m * positives + place
        for rank in range(found.filled[at]):
            if found.score[at, rank] > least:
                yield m, place, best.id[m, place], best.score[m, place], rank + 1, found.id[at, rank], found.score[at, rank]


_OUT = {"anchor_id": pa.int64(), "positive_id": pa.int64(), "rank": pa.int32(), "negative_id": pa.int64(), "positive_score": pa.int64(), "negative_score": pa.int64(), "positive_rank": pa.int32()}


def hard_negatives(rows: DataFrame, anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
                   positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """Per anchor (rows where ``anchor`` holds) and each of its first ``positives`` other rows of its label: the first ``negatives``
    rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score. Columns: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score, positive_rank."""
    spark = rows.sparkSession
    table = prepared(rows, vec_id, vector, label, anchor)
    total, d = table.agg(F.count(F.when(F.col("anchor"), 1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).head()
    d = max(1, d)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, positive_rank int"
    if not total:
        return spark.createDataFrame([], schema)
    centres = fit_centres(table.where("anchor"), total, d)
    dealt = _dealt(table, spark.sparkContext.broadcast(centres), d)
    shared = spark.sparkContext.broadcast(write_cells(dealt, centres, d))
    sizes = cut(dealt.where("anchor").groupBy("cell").agg(F.count("*").alias("n")), "anchor-cells")  # one row a centre
    member = F.struct("key", "id", "label", "vector")
    grouped = dealt.where("anchor").join(F.broadcast(sizes), "cell").withColumn("chunk", F.pmod(F.xxhash64("key"), F.ceil(F.col("n") / GROUP)))
    groups = cut(grouped.groupBy("cell", "chunk").agg(F.max("angle").alias("radius"), F.sort_array(F.collect_list(member)).alias("members")), "anchor-groups")

    def run(batches):
        cells = shared.value
        for b in batches:
            for g in range(b.num_rows):
                cell, radius = b.column("cell")[g].as_py(), b.column("radius")[g].as_py()
                m = b.column("members").slice(g, 1).flatten()
                keys, ids, labels = (m.field(c).to_numpy(zero_copy_only=False) for c in ("key", "id", "label"))
                got = list(mine(cells, keys, labels, matrix(m.field("vector"), cells.d), cells.centres[cell], radius, positives, negatives, low, high))
                if got:
                    at, place, pos, pos_score, rank, neg, neg_score = (np.array(c) for c in zip(*got))
                    cols = (ids[at], pos, rank, neg, pos_score, neg_score, place + 1)
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(t.to_pandas_dtype())) for c, t in zip(cols, _OUT.values())], names=list(_OUT))

    n = max(1, min(4096, groups.count()))
    out = groups.repartition(n, "cell", "chunk").mapInArrow(run, schema)
    return out.select("anchor_id", key_back("positive_id").alias("positive_id"), "rank", key_back("negative_id").alias("negative_id"), "positive_score", "negative_score", "positive_rank")


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of all anchors (ids divisible by 100) among all rows; ids divisible by 7 get the next label first."""
    rows = read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = hard_negatives(rows, F.col("vec_id") % 100 == 0, label=label)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = """
WITH kept AS (SELECT row_number() OVER () AS k, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.k AS ak, a.vec_id AS anchor_id, r.k AS rk, r.vec_id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM kept a, kept r WHERE a.vec_id % 100 = 0),
positives AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ak ORDER BY score DESC, vec_id NULLS FIRST, rk) AS place FROM scored WHERE same AND rk <> ak) WHERE place <= 5),
negatives AS (SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.ak, p.rk ORDER BY n.score DESC, n.vec_id NULLS FIRST, n.rk) AS rank
  FROM positives p JOIN scored n ON n.ak = p.ak AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5"""
