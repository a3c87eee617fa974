"""Operator 7 and the pipeline."""

import gzip
import hashlib
import io
import os
import re
import sys
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sellake.llm import op07_warc as w
from sellake.llm.common import cut
from test_text import components, quality_counts

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


def pages(spark):
    big, same = "<p>" + "é" * 600, "y" * 1000
    rows = [(1, "http://a/1", big), (5, None, big), (9, "http://a/9\r\nX: y", big), (2, "u", "small"), (3, "u", "small"), (4, "u", None), (6, "u", ""), (7, "u", same), (8, "u", same), (8, "u", same), (None, "n", same), (10, "u", "\r\n\r\nWARC/1.1\r\n" * 200)]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, digest string, top int")


def test_warc_round_trip(spark):
    manifest = w.write_warc(pages(spark), tempfile.mkdtemp())
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in w.read_warc(manifest).collect()), key=str)
    rows, want = pages(spark).collect(), []
    for r in rows:
        raw = (r.html or "").encode()
        top = max((x.page_id for x in rows if (x.html or "").encode() == raw and x.page_id is not None), default=None) if len(raw) >= 1000 else r.page_id
        want.append((r.page_id, len(raw), hashlib.sha1(raw).hexdigest(), "response" if top == r.page_id else "revisit", None if top == r.page_id else top))
    assert got == sorted(want, key=str)
    for m in manifest.collect():  # each member is a record that any gzip reader takes
        data = open(m.path.removeprefix("file:"), "rb").read()
        offsets = [at for at, _, _ in w.read_records(io.BytesIO(data), portion=7)]
        for a, b in zip(offsets, [*offsets[1:], len(data)]):
            assert gzip.decompress(data[a:b]).startswith(b"WARC/1.1\r\n")
    assert w.write_warc(pages(spark).limit(0), tempfile.mkdtemp()).count() == 0
    assert w.read_warc(w.write_warc(pages(spark).limit(0), tempfile.mkdtemp())).count() == 0


def test_warc_files_are_closed_at_their_size(spark, monkeypatch):
    monkeypatch.setattr(w, "FILE_BYTES", 600)
    manifest = w.write_warc(pages(spark), tempfile.mkdtemp())
    assert manifest.count() > 3 and w.read_warc(manifest).count() == pages(spark).count()


def test_warc_faults():
    good = w.page_record(1, "u", b"payload", 7, hashlib.sha1(b"payload").hexdigest(), None, "2020-01-01T00:00:00Z")
    plain = gzip.decompress(good)
    assert [h["warc-type"] for _, h, _ in w.read_records(io.BytesIO(good * 3), 5)] == ["response"] * 3
    assert list(w.read_records(io.BytesIO(b""))) == []
    bad = [good[:-9], good + b"x", gzip.compress(plain.replace(b"payload\r\n", b"paYload\r\n")), gzip.compress(plain[:-2]), gzip.compress(b"HTTP/1.1 200\r\n\r\n"), gzip.compress(plain.replace(b"Content-Length: ", b"Content-Length: 9", 1))]
    for data in bad:
        with pytest.raises(w.WarcError):
            list(w.read_records(io.BytesIO(data)))


def test_long_lines_of_two_documents(spark):
    import corpus_pipeline as c

    said = lambda k, n: " ".join(f"{k}{i}" for i in range(n))
    texts = {1: [said("a", 60), said("long", 51), "short"], 2: [said("b", 60), " " + said("LONG", 51), "short"], 3: [said("c", 60), said("mid", 50)],
             4: [said("d", 60), said("mid", 50)], 5: [said("e", 60), said("f", 60)], 6: [said("e", 60), said("f", 60) + " z"], 7: [said("g", 60)]}
    docs = spark.createDataFrame([(i, "\n".join(x), "en", "s", sum(map(len, x)) + len(x) - 1) for i, x in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in c.near_duplicates(spark, docs, "").collect()}
    want = {i: "\n".join(x if i != 2 else [x[0], x[2]]) for i, x in texts.items() if i != 6}
    assert {i: r.text for i, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())


def test_pipeline(spark):
    import corpus_pipeline as c
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.withColumn("n_words", docs.lang)  # a column whose name a stage uses too
    odd = spark.createDataFrame([(None, None, None, None, None, None), (10**6, "", None, "s", 0, "x"), (10**6 + 1, "12 34 56 78 9 1 2 3 4 5 6", "en", "s", 0, "x")], docs.schema)
    rows = docs.union(odd)
    for name, stage in c.STAGES[:-1]:
        before = {r.doc_id: r for r in rows.collect()}
        kept = cut(stage(spark, rows, sf), "stage")
        assert kept.columns == docs.columns
        after = {r.doc_id: r for r in kept.collect()}
        assert len(after) == kept.count() and set(after) <= set(before), name
        if name == "quality rules":  # too few labels for a cutoff here: the base rule alone
            counts = {i: quality_counts(r.text) for i, r in before.items()}
            assert set(after) == {i for i, n in counts.items() if n[0] >= 10 and 100 * n[4] <= 20 * n[0]}
        elif name == "language ID":
            assert len(after) >= 0.97 * len(before) and all(re.search("[^\\W\\d_]", r.text) for r in after.values())
        elif name == "line dedup":
            key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({k: k + 32 for k in range(65, 91)})
            seen, first = Counter(), {}
            for i in sorted(before):
                for k in {key(x) for x in before[i].text.split("\n")} - {""}:
                    seen[k] += 1
                    first.setdefault(k, i)
            for i, r in before.items():
                lines, had = [], set()
                for x in r.text.split("\n"):
                    k = key(x)
                    if seen[k] < c.LINE_DOCS or (first[k] == i and k not in had):
                        lines.append(x)
                        had.add(k)
                assert after[i].text == "\n".join(lines) and after[i].n_chars == len(after[i].text)
        else:
            want = components([(i, r.text) for i, r in before.items()], c.SHINGLE, c.PERCENT)
            assert set(after) == {i for i, _, k in want if i == k}
        rows = kept
    packed = c.packing(spark, rows, sf).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert {r.doc_id for r in packed} == set(after) and all(r.n == r["all"] for r in packed)
    assert 0.5 * docs.count() < rows.count() <= docs.count()
    assert {"pipeline", *(f"op{n}" for n in range(1, 11))} <= {k.split("_")[0] for k in entry.queries()}
    assert len(c.STAGES) == 5 and c.ORACLE_SQL is None
