"""Operators 12 and 13 against brute force on small fixtures."""

import math
import random
import re
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sellake.llm import op12_audit as audit
from sellake.llm import op13_negatives as mining

SPACE = r"[^\x20\x09-\x0D]+"


def test_shapley_is_the_mean_over_all_orders():
    rnd = random.Random(1)
    for m in (1, 2, 3, 5):
        for _ in range(5):
            v = audit.removals([rnd.randrange(50) for _ in range(1 << m)])
            mean = [Fraction(0)] * m
            for order in permutations(range(m)):
                before = 0
                for i in order:
                    mean[i] += Fraction(v[before | 1 << i] - v[before], math.factorial(m))
                    before |= 1 << i
            assert audit.shapley(v) == mean


def fails(t):
    t = t or ""
    w = re.findall(SPACE, t)
    return [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search(r"[#$%&*|]", t))]


def audit_fixture():
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(400)] + ["BIG", "a|b", "É", "中\x85文"]
    texts = [None, "", "", " \n\t", "one", "x" * 3_000_000, "Word " * 300_000]
    texts += [" ".join(rnd.choice(words[: rnd.choice([30, 404])]) for _ in range(rnd.choice([5, 199, 200, 260]))) for _ in range(40)]
    texts += [rnd.choice(texts) for _ in range(25)]
    docs = [(rnd.choice([i, i, i, None, 3]), t, rnd.choice(["en", "de", None]), "part", 1, True) for i, t in enumerate(texts)]
    labels = [(rnd.choice([i, None, 10**9]), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(70) for _ in range(rnd.choice([0, 1, 2]))]
    return docs, labels


def test_audit_against_brute_force(spark):
    docs, labels = audit_fixture()
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, part string, mask int, is_first boolean")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in audit.audit(audit.mask_counts(audit.failures(frame), marks)).collect()}
    good, toxic = ({d for d, *v in labels if d is not None and v[k] == 1} for k in (0, 1))
    rows = []
    for d, t, lang, *_ in docs:
        repeat = d is not None and any(e is not None and e < d and (u or "") == (t or "") for e, u, *_ in docs)
        rows.append((lang or "", dict(zip("ABCDE", [*fails(t), repeat])), d in good, d in toxic))
    assert len(got) == 600 * len({r[0] for r in rows})
    for part in {r[0] for r in rows}:
        own, total, want = [r for r in rows if r[0] == part], dict.fromkeys("ABCDE", 0), {}
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone, stay = [r for r in left if r[1][f]], [r for r in left if not r[1][f]]
                total[f] += len(gone)
                want[order, step] = (len(stay), len(gone), sum(r[1][f] for r in own) - len(gone), sum(r[1][f] and sum(r[1].values()) == 1 for r in own),
                                     sum(r[2] for r in gone), sum(r[3] for r in gone))
                left = stay
        for (order, step), w in want.items():
            assert got[part, order, step] == (*w, total[order[step - 1]])


def test_audit_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert audit.audit(audit.mask_counts(audit.failures(empty), spark.createDataFrame([], "doc_id long, quality int, toxic int"))).count() == 0


def brute(rows, positives=5, negatives=5):
    kept = []
    for k, (i, v, lab, a) in enumerate(rows):
        if v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((k, i, [math.floor(256 * x) for x in v], lab, a))
    out = []
    dot = lambda x, y: sum(p * q for p, q in zip(x, y))
    first = lambda i: -1 if i is None else i
    for k, i, v, lab, a in kept:
        if not a or i is None:
            continue
        scored = [(-dot(v, w), first(j), j, m, q) for q, j, w, m, _ in kept]
        pos = sorted((r for r in scored if r[3] == lab and r[4] != k), key=lambda r: r[:2])[:positives]
        for p in pos:
            neg = sorted((r for r in scored if r[3] != lab and 80 * -p[0] <= 100 * -r[0] <= 100 * -p[0]), key=lambda r: r[:2])[:negatives]
            out += [(i, p[2], n, r[2], -p[0], -r[0]) for n, r in enumerate(neg, 1)]
    return sorted(out, key=str)


def mined(spark, rows, **kw):
    frame = spark.createDataFrame([(i, v, lab, a, "x", 1, 0.5) for i, v, lab, a in rows], "vec_id long, embedding array<double>, label int, is_anchor boolean, cell string, key int, angle double")
    return mining.hard_negatives(frame, F.col("is_anchor"), **kw)


def clustered(rnd, n, d, middles, spread, anchors):
    centre = rnd.normal(size=(middles, d))
    for i in range(n):
        v = centre[rnd.integers(middles)] * rnd.uniform(0.5, 2) + rnd.normal(size=d) * spread
        yield i, v.tolist(), int(rnd.integers(4)), bool(i % anchors == 0)


@pytest.mark.parametrize("middles, spread", [(1, 1.0), (12, 0.05)])
def test_negatives_against_brute_force(spark, monkeypatch, middles, spread):
    monkeypatch.setattr(mining, "GROUP", 7)
    monkeypatch.setattr(mining, "FILE_ROWS", 50)
    rows = list(clustered(np.random.default_rng(3), 700, 8, middles, spread, 9))
    assert sorted(map(tuple, mined(spark, rows).drop("positive_rank").collect()), key=str) == brute(rows)


def test_negatives_of_odd_rows(spark):
    rnd = random.Random(4)
    vectors = [None, [], [None, 1.0], [float("nan"), 1.0], [float("inf"), 0.0], [0.0, 0.0], [1.0], [1.0, 1.0, 1.0], [-1.0, -1.0], [0.5, 0.5], [0.5, 0.5], [1.0, 0.0], [0.001, -0.001]]
    rows = [(rnd.choice([i, i, 5, None]), rnd.choice(vectors), rnd.choice([0, 1, 1, None]), rnd.choice([True, True, False, None])) for i in range(150)]
    assert sorted(map(tuple, mined(spark, rows).drop("positive_rank").collect()), key=str) == brute(rows)
    for none in ([], [(1, [1.0], 0, False)], [(1, [1.0], None, True)], [(None, [1.0], 0, True)], [(1, [], 0, True)]):
        assert mined(spark, none).count() == 0
    assert sorted(map(tuple, mined(spark, rows, positives=2, negatives=3).drop("positive_rank").collect()), key=str) == brute(rows, 2, 3)


def test_large_numbers_stay_exact(spark):
    rows = [(i, [2.0**20 + i % 3, 3.0**12 + i % 5, 1e7 + i], i % 3, i % 4 == 0) for i in range(40)]
    assert sorted(map(tuple, mined(spark, rows).drop("positive_rank").collect()), key=str) == brute(rows)
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, [(i, [1e12 + i, 1.0], i % 2, True) for i in range(8)]).count()


def test_walks_end_early():
    """On clustered vectors the certified walk looks at a part of the candidates only."""
    rows = list(clustered(np.random.default_rng(5), 6000, 8, 40, 0.02, 10))
    x = np.floor(np.array([r[1] for r in rows]) * 256).astype(np.int64)
    units, length = mining.directions(x)
    centre = units[0]
    seen = []

    class Cells:
        d = 8

        def in_order(self, centre, radius):
            yield 0, float(length.max())

        def blocks(self, cell):
            import pyarrow as pa

            order = np.argsort(-(units @ centre))
            for i in range(0, len(order), 500):
                o = order[i : i + 500]
                yield pa.RecordBatch.from_pydict({"key": o, "id": o, "label": np.array([rows[k][2] for k in o]), "vector": pa.array(x[o].tolist(), pa.list_(pa.int64())), "length": length[o]})

    best = mining.Best(1, 5)

    def take(going, keys, ids, labels, s):
        seen.append(len(keys))
        a, b = np.nonzero(s >= best.worst()[going][:, None])
        best.add(going[a], s[a, b], ids[b])

    mining.walk(Cells(), x[:1], length[:1], centre, 0.0, lambda: best.worst().astype(float), take, step=100)
    assert sum(seen) < 3000
    want = sorted(zip(-(x @ x[0]), range(len(x))))[:5]
    assert list(zip((-best.score[0]).tolist(), best.id[0].tolist())) == [(int(a), b) for a, b in want]
