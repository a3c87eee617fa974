"""Operator 8, SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

At each position the automaton follows its output links to all pieces that end there, and each relaxes the best score of the
position. The segmentation of a text is the one whose pieces have the greatest sum of scores; a character in no piece
costs the least score less 10 and, where the model has byte pieces, becomes its UTF-8 bytes.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ChunkTable, portions, read

SPACE = "▁"


class PieceEncoder(ChunkTable):
    """Encoder and decoder of a SentencePiece model file.

    Where no piece has a space mark after another character, as in public models, no piece crosses the start of a word: then
    the best segmentation of a text is that of its words in a row, and each distinct word is segmented once (in a bounded
    table for all tasks of a worker). Otherwise whole texts are segmented.
    """

    _made: dict[str, PieceEncoder] = {}
    _CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    @classmethod
    def of(cls, path: str) -> PieceEncoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str, entries: int = 600_000, portion: int = 2 << 20, proto: bytes | None = None):
        import ahocorasick
        import sentencepiece

        super().__init__(entries)
        self.model = m = sentencepiece.SentencePieceProcessor(model_proto=proto) if proto else sentencepiece.SentencePieceProcessor(model_file=path)
        self.portion, self.table, self.bytes, self.single, self.unknown = portion, [], {}, set(), m.unk_id()
        self.automaton, least, names = ahocorasick.Automaton(), 0.0, []
        for i in range(m.get_piece_size()):
            piece, score = m.id_to_piece(i), m.get_score(i)
            if m.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.table.append(bytes([int(piece[3:5], 16)]))
            elif m.is_control(i) or m.is_unknown(i):
                self.table.append(b"" if m.is_control(i) else " ⁇ ".encode())
            else:
                self.table.append(piece.replace(SPACE, " ").encode())
                if not m.is_unused(i):
                    names.append(piece)
                    least = min(least, score)
                    self.automaton.add_word(piece, (len(piece), i, score))
                    if len(piece) == 1:
                        self.single.add(piece)
        self.automaton.make_automaton()
        self.penalty = least - 10.0
        self.by_word = not any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in names)
        self.prefix = m.normalize("a").startswith(SPACE)

    def viterbi(self, text: str) -> tuple[list[int], float]:
        """Ids and score of a normalized text."""
        best, back, single, penalty, done = [0.0] * (len(text) + 1), [None] * (len(text) + 1), self.single, self.penalty, 0
        for end, (length, piece, score) in self.automaton.iter(text):
            end += 1
            while done < end:  # positions in order; without a piece of its own a character is unknown
                done += 1
                best[done] = best[done - 1] + penalty if text[done - 1] not in single else -1e300
            got = best[end - length] + score
            if got > best[end]:
                best[end], back[end] = got, (length, piece)
        while done < len(text):
            done += 1
            best[done] = best[done - 1] + penalty
        out, at = [], len(text)
        while at:
            if back[at] is None:
                raw = text[at - 1].encode()
                out += [self.bytes[b] for b in reversed(raw)] if len(self.bytes) == 256 else [self.unknown]
                at -= 1
            else:
                out.append(back[at][1])
                at -= back[at][0]
        return out[::-1], best[-1]

    def _learn(self, chunks: list[str]) -> None:
        """A chunk stands after a space mark that is left out, or begins with its newline; one with FIRST is as it is."""
        made = [self.viterbi(p[1:] if p[0] == self.FIRST else p if p[0] == "\n" else SPACE + p) for p in chunks]
        self._keep(chunks, [m[0] for m in made], scores=[m[1] for m in made])

    def _chunks(self, norm: str) -> list[str]:
        return [self.FIRST + c for c in (self._CHUNK.findall(norm) if self.by_word else [norm])] if norm else []

    def each(self, texts):
        """(ids, score) of each text of an Arrow string array; NULL and empty texts have no ids."""
        import pyarrow.compute as pc

        for some in portions(texts, self.portion):
            norms = [self.model.normalize(t) if t else "" for t in some]
            plain = [self.by_word and len(n) > 1 and n[0] == SPACE and n[-1] != SPACE and SPACE * 2 not in n and SPACE + "\n" not in n and self.FIRST not in n for n in norms]
            split = pc.split_pattern(pa.array([n[1:].replace("\n", SPACE + "\n") for n, ok in zip(norms, plain) if ok], pa.large_string()), SPACE)
            coded = split.flatten().dictionary_encode()
            numbers = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
            ids, ends = self._gather(numbers)
            sums, at = np.concatenate([[0.0], np.cumsum(self.scores[numbers])]), split.offsets.to_numpy() - split.offsets[0].as_py()
            ends, k = np.concatenate([[0], ends]), 0
            for norm, ok in zip(norms, plain):
                if ok:
                    a, b = at[k], at[k + 1]
                    yield ids[ends[a] : ends[b]], float(sums[b] - sums[a])
                    k += 1
                else:
                    yield self._one(norm)

    def _one(self, norm: str):
        chunks = self._chunks(norm)
        unique = list(dict.fromkeys(chunks))
        number = dict(zip(unique, self._numbers(unique).tolist()))
        numbers = np.array([number[c] for c in chunks], np.int64)
        return self._gather(numbers)[0], float(self.scores[numbers].sum())

    def encode(self, text: str | None) -> tuple[list[int], float]:
        ids, score = next(iter(self.each(pa.array([text], pa.string()))))
        return ids.tolist(), score

    def decode(self, ids) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD, and the space the model puts first goes."""
        text = b"".join([self.table[i] for i in ids]).decode("utf-8", "replace")
        return text.removeprefix(" ") if self.prefix else text


def encode_documents(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (little-endian uint32), n_pieces, score and ``decoded`` (the text of the ids) per row, without a shuffle.

    NULL and empty texts have no pieces and decode to the empty text; ids may be NULL or repeat; an empty table gives no rows.
    A very long text is cut at spaces and its words are coded one by one. Only the id and the text are read, so other columns may have any names.
    """

    def run(batches):
        encoder = PieceEncoder.of(model)
        for b in batches:
            at = 0
            for part in portions(b.column(1), 4 << 20):
                got = list(encoder.each(pa.array(part, pa.string())))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(part)), pa.array([g[0].tobytes() for g in got], pa.binary()), pa.array([len(g[0]) for g in got], pa.int64()), pa.array([g[1] for g in got]), pa.array([encoder.decode(g[0].tolist()) for g in got], pa.string())],
                                                 names=["doc_id", "ids", "n_pieces", "score", "decoded"])
                at += len(part)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).mapInArrow(run, "doc_id long, ids binary, n_pieces long, score double, decoded string")


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded; SQL has no Viterbi, so the tests compare with brute force and with the library."""
    import public_tokenizers

    out = encode_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_pieces", F.crc32("ids").alias("ids_crc32"), "score", F.sha2("decoded", 256).alias("decoded_sha256"))
