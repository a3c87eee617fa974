"""Operators 1, 2, 8 and 10: token counts, token files, SentencePiece and packing against the libraries and brute force."""

import random
import re
import tempfile
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")

from sellake.llm.common import ChunkEncoder  # noqa: E402
from sellake.llm.op01_token_rollup import WORDS, TokenRollup  # noqa: E402
from sellake.llm.op02_arrow_tokens import TokenFile, read_documents, write_token_files  # noqa: E402
from sellake.llm.op08_sentencepiece import PieceEncoder, encode_documents  # noqa: E402
from sellake.llm.op10_packing import digest, pack, piece_lengths, write_buckets  # noqa: E402

BYTE, WORD, PIECE = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, ids string, start int, source string, lang string"
TEXTS = [
    "The cat.\nSat on the mat, twice.", "", None, " lead and trail ", "two  spaces\n\n\nand\ttabs", "Straße ÉTÉ où", "é combined", "中文 mixed 😀 text", "<|endoftext|> is text <|endoftext|>",
    "\x01 mark \x02 first", "x" * 3000, "don't we'll I'm 'tis", "The cat.\nSat on the mat, twice.", "word " * 3000, "\n", " ", "AİB ΣΑΣ", "..., !? ;;", "　wide line",
]


def docs(spark, texts=TEXTS):
    rows = [(i * 3 - 6, t, "clash", i, "s" if i % 2 else None, "en") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, "no id", "clash", 0, "s", None), (0, TEXTS[2], "clash", 1, "s", "en")], SCHEMA)


def library(path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_chunks_give_the_library_s_ids(path):
    own, ref, rnd = ChunkEncoder(path, entries=500, portion=2000), library(path), random.Random(7)
    bits = ["a", "Word", "é", "́", " ", " ", "  ", "\n", "\t", "\x1c", "'s", ".", "..", "!", "12", "\x01", "\x02", "中", "😀", "ß", "Σ", "<|endoftext|>", "the"]
    texts = TEXTS + ["".join(rnd.choice(bits) for _ in range(rnd.randrange(16))) for _ in range(1500)]
    texts += [" ".join(rnd.choice(["alpha", "Beta", "gamma.", "delta,", "straße", str(i)]) + "xy"[i % 2] * (i % 40) for _ in range(9)) for i in range(800)]
    assert own.plain
    for t, ids in zip(texts, own.each(pa.array(texts, pa.string()))):
        assert ids.tolist() == ref(t), repr(t)


@pytest.mark.parametrize("change", [{"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}}, {"normalizer": {"type": "Lowercase"}},
                                    {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}}])
def test_files_with_other_rules_get_whole_texts(tmp_path, change):
    import json

    rules = json.load(open(BYTE)) | change
    path = str(tmp_path / "other.json")
    with open(path, "w") as f:
        json.dump(rules, f)
    own, ref = ChunkEncoder(path), library(path)
    assert not own.splits and ChunkEncoder(BYTE).splits and ChunkEncoder(WORD).splits
    for t, ids in zip(TEXTS, own.each(pa.array(TEXTS, pa.string()))):
        assert ids.tolist() == ref(t), repr(t)


def test_very_long_texts(spark):
    """Texts of several portions through token files and packing."""
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice(["alpha", "Beta,", "gamma.", "é", str(k)]) for k in range(900_000)), "x" * 4_000_000, "short"]
    assert len(texts[0]) > 4 << 20
    given = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ref, out = library(BYTE), tempfile.mkdtemp()
    got = {r.doc_id: r for r in read_documents(write_token_files(given, out, BYTE, end_id=0)).collect()}
    for i, t in enumerate(texts):
        ids = np.array([*ref(t), 0], "<u4")
        assert (got[i].n_tokens, got[i].ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
    word = library(WORD)
    whole = {}
    for r in sorted(pack(given, WORD, end_id=1).collect(), key=lambda r: (r.doc_id, r.start)):
        whole[r.doc_id] = whole.get(r.doc_id, b"") + bytes(r.ids)
    assert all(whole[i] == np.array([*word(t), 1], "<u4").tobytes() for i, t in enumerate(texts))


def test_token_files_round_trip(spark):
    out = tempfile.mkdtemp()
    manifest = write_token_files(docs(spark), out, BYTE, end_id=0, seq_len=16)
    ref, rows = library(BYTE), sorted(docs(spark).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    got = sorted(read_documents(manifest).collect(), key=lambda r: r.start)
    at = 0
    for r, g in zip(rows, got, strict=True):
        ids = np.array([*ref(r.text), 0], "<u4")
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (r.doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    for m in manifest.collect():
        file = TokenFile(m.path)
        flat = np.concatenate([file.ids(i)[file.mask(i)] for i in range(m.n_rows)])
        assert len(flat) == m.n_tokens and all(len(file.ids(i)) == 16 for i in range(m.n_rows))
        row, batch = file.ids(0), file.reader.get_batch(0).column("ids").values.buffers()[1]
        assert batch.address <= row.ctypes.data < batch.address + batch.size and not row.flags.owndata  # a view of the file
    assert read_documents(write_token_files(docs(spark).limit(0), tempfile.mkdtemp(), BYTE, 0)).count() == 0
    with pytest.raises(Exception, match="cannot hold"):
        write_token_files(docs(spark), tempfile.mkdtemp(), BYTE, 0, id_type="uint8").count()


def test_packing(spark):
    assert piece_lengths(0) == [] and piece_lengths(2048 * 2 + 5) == [2048, 2048, 4, 1] and piece_lengths(7, 4) == [4, 2, 1]
    with pytest.raises(ValueError):
        piece_lengths(3, 6)
    sequences = write_buckets(pack(docs(spark), WORD, end_id=1, max_len=64), tempfile.mkdtemp() + "/b")
    assert all(r.bucket == r.length == len(r.ids) // 4 for r in sequences.collect())
    rows, ref = digest(sequences).collect(), library(WORD)
    assert len({r.sequence_id for r in rows}) == len(rows) and all(r.length & (r.length - 1) == 0 and r.length <= 64 and r.offset == 0 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for d in docs(spark).where("doc_id <> 0 or doc_id is null").collect():
        ids, at = np.array([*ref(d.text), 1], "<u4"), 0
        for r in sorted(by[d.doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    assert pack(docs(spark).limit(0), WORD, 1).count() == 0


def brute_viterbi(e, text):
    """Best score by trying all pieces at all places."""
    pieces = {e.model.id_to_piece(i): e.model.get_score(i) for i in range(e.model.get_piece_size()) if not (e.model.is_byte(i) or e.model.is_control(i) or e.model.is_unknown(i))}
    best = [0.0] + [None] * len(text)
    for j in range(1, len(text) + 1):
        options = [best[i] + pieces[text[i:j]] for i in range(max(0, j - 20), j) if text[i:j] in pieces]
        best[j] = max(options + ([] if text[j - 1] in pieces else [best[j - 1] + e.penalty]))
    return best[-1]


def test_sentencepiece(spark):
    e, rnd = PieceEncoder(PIECE, entries=300, portion=500), random.Random(3)
    bits = ["the", "ing", " ", "  ", "\n", "a", "é", "中", "😀", "\t", "x", ".", " and ", "\x02"]
    texts = [t for t in TEXTS if t is not None and len(t) < 200] + ["".join(rnd.choice(bits) for _ in range(rnd.randrange(12))) for _ in range(150)]
    for t, (ids, score) in zip(texts, e.each(pa.array(texts, pa.string()))):
        assert e.decode(ids.tolist()) == t
        if t:
            assert score == pytest.approx(brute_viterbi(e, e.model.normalize(t)))
            whole, s = e.viterbi(e.model.normalize(t))
            assert s == pytest.approx(score) and e.decode(whole) == t
    assert e.decode([0xE9 + 3]) == "�" and e.encode(None) == ([], 0.0)
    out = {r.doc_id: r for r in encode_documents(docs(spark), PIECE).where("doc_id <> 0").collect()}
    assert all(out[r.doc_id].decoded == (r.text or "") for r in docs(spark).where("doc_id <> 0").collect())
    assert encode_documents(docs(spark).limit(0), PIECE).count() == 0


def test_rollup(spark):
    rollup = TokenRollup(spark, tempfile.mkdtemp(), {"b": BYTE, WORDS: None})
    cols, state, rnd, ref = "op string, doc_id long, source string, lang string, text string, seq int, extra int", {}, random.Random(5), library(BYTE)
    assert rollup.totals().count() == 0
    for n in range(4):
        rows = [(rnd.choice(["insert", "revise", "delete", "other"] if n else ["insert"]), rnd.choice([None, *range(12)]), rnd.choice(["s", None, "t"]), rnd.choice(["en", None]), rnd.choice(TEXTS), i, 1) for i in range(20 if n != 2 else 0)]
        changes = spark.createDataFrame(rows, cols)
        if n == 1:  # a batch that was cut off before its commit leaves a folder that counts for nothing
            spark.createDataFrame([(1, "s", "en", "b", 5, 5)], "doc_id long, source string, lang string, tokenizer string, docs long, tokens long").write.parquet(f"{rollup.path}/ledger/n1")
        assert rollup.commit(f"n{n}", changes) and not rollup.commit(f"n{n}", changes)
        last = {}
        for r in rows:
            if r[0] != "other" and (r[1] is not None or r[0] != "delete"):
                last[r[1] if r[1] is not None else (n, r[5])] = r  # a row without an id is a document of its own
        for k, r in last.items():
            state.pop(k, None)
            if r[0] != "delete":
                state[k] = r
        want = Counter()
        for _, _, s, lang, t, *_ in state.values():
            for name, size in (("b", len(ref(t))), (WORDS, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")))):
                want[(s, lang, name, "docs")] += 1
                want[(s, lang, name, "tokens")] += size
        got = {(r.source, r.lang, r.tokenizer, k): r[k] for r in rollup.totals().collect() for k in ("docs", "tokens")}
        assert got == dict(want)
    with pytest.raises(ValueError):
        rollup.commit("../x", changes)
