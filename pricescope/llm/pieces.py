"""SentencePiece encoding and decoding by Aho-Corasick, with Viterbi or merges by the model's kind (operator 8).

The vocabulary's pieces form an Aho-Corasick automaton.  One pass over the
text meets, at each position, every piece that ends there (the state's own
piece and those along its output links).  The scores of a unigram model are
log-probabilities: the pass relaxes the best score of a segmentation up to
each position, the single-pass Viterbi search for the pieces with the
greatest sum of scores.  Those of a BPE model are minus merge ranks, whose
sum means nothing: there the pass finds the places that no piece spans, and
the characters between are merged in the order of the ranks.  Characters
that no piece covers are spelt by byte pieces.

No piece joins a character to a following space mark, so a text is cut
before each run of marks and around line ends, and the best segmentation of
the text is that of its parts in order, by either method; short parts are remembered.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: SentencePiece's space mark.
MARK = "▁"
#: Score of a byte-spelt character below the lowest piece, as in SentencePiece's unknown penalty.
PENALTY = 10.0
REMEMBER, SHORT = 400_000, 48
#: Rank of a pair that is no piece.
NEVER = float("inf")


class PieceCoder(dict):
    """Encodes texts to ids by Viterbi and back; a dict of parts already encoded (ids as int32 bytes)."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece
        super().__init__()
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.auto = ahocorasick.Automaton()
        self.raw, self.byte, low, inner = [], {}, 0.0, set()
        for i in range(m.get_piece_size()):
            p = m.id_to_piece(i)
            if m.is_byte(i):
                self.byte[int(p[3:-1], 16)] = i
                self.raw.append(bytes([int(p[3:-1], 16)]))
            elif m.is_control(i) or m.is_unknown(i) or m.is_unused(i):
                self.raw.append(b"")
            else:
                self.raw.append(p.replace(MARK, " ").encode())
                low = min(low, m.get_score(i))
                self.auto.add_word(p, (i, len(p), m.get_score(i)))
                inner.update(p[:-1] if len(p) > 1 else "", p[1:])
                if MARK in p.lstrip(MARK):
                    raise ValueError(f"piece {p!r} holds a space mark after other characters")
        self.auto.make_automaton()
        self.unknown = low - PENALTY
        ends = "" if "\n" in inner else "\n"
        self.parts = re.compile(f"{ends}|{MARK}*[^{MARK}{ends}]+|{MARK}+" if ends else f"{MARK}*[^{MARK}]+|{MARK}+").findall
        self.raw = np.array(self.raw, object)

    def viterbi(self, part: str) -> list[int]:
        """Ids of the best segmentation; of equal ones, that with the longest last piece."""
        n = len(part)
        best, back = [0.0] * (n + 1), [None] * (n + 1)
        at, unknown = 0, self.unknown
        for last, (i, size, score) in self.auto.iter(part):
            end = last + 1
            while at < end:  # each position is first reached by spelling its character
                best[at + 1] = best[at] + unknown
                at += 1
            s = best[end - size] + score
            if s > best[end]:
                best[end], back[end] = s, (i, size)
        out = []
        while n:
            if back[n] is None:
                out.extend(self.byte[x] for x in reversed(part[n - 1].encode()))
                n -= 1
            else:
                i, size = back[n]
                out.append(i)
                n -= size
        return out[::-1]

    def segment(self, part: str) -> list[int]:
        """Ids of a part by the method of this coder."""
        return self.viterbi(part)

    def __missing__(self, part: str) -> bytes:
        got = np.array(self.segment(part), "<i4").tobytes()
        if len(part) <= SHORT:
            if len(self) >= REMEMBER:
                self.clear()
            self[part] = got
        return got

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; a space mark written in the text itself is spelt by bytes, so decoding is exact."""
        if not text:
            return np.empty(0, "<i4")
        spelt = np.array([self.byte[x] for x in MARK.encode()], "<i4").tobytes()
        pieces = [b"".join(map(self.__getitem__, self.parts(p.replace(" ", MARK)))) for p in f" {text}".split(MARK)]
        return np.frombuffer(spelt.join(pieces), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: the inverse of ``encode``."""
        return b"".join(self.raw[ids].tolist())[1:].decode("utf-8", "replace")


class MergeCoder(PieceCoder):
    """Encodes by merges as SentencePiece does for BPE: the adjacent pair of the greatest score first, of equal ones the leftmost."""

    def __init__(self, path: str):
        super().__init__(path)
        self.piece = {p: (-score, i) for p, (i, _, score) in self.auto.items()}

    def segment(self, part: str) -> list[int]:
        n = len(part)
        if n <= SHORT:
            return self.merge_short(part)
        inside = bytearray(n + 1)  # 1 where a piece holds the character and the one before
        for last, (_, size, _) in self.auto.iter(part):
            if size > 1:
                inside[last - size + 2:last + 1] = b"\1" * (size - 1)
        out, start = [], 0
        while start < n:
            end = inside.find(0, start + 1)
            out.extend(self.merge(part[start:end]))
            start = end
        return out

    def merge_short(self, part: str) -> list[int]:
        """As ``merge``, by a list of the pairs' scores: faster on a few characters."""
        none = (NEVER, -1)
        get, run = self.piece.get, list(part)
        pairs = [get(a + b, none)[0] for a, b in zip(run, run[1:])]
        while pairs and (least := min(pairs)) < NEVER:
            at = pairs.index(least)
            run[at:at + 2] = [run[at] + run[at + 1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = get(run[at] + run[at + 1], none)[0]
            if at:
                pairs[at - 1] = get(run[at - 1] + run[at], none)[0]
        out = []
        for p in run:
            if got := get(p):
                out.append(got[1])
            else:
                out.extend(self.byte[x] for x in p.encode())
        return out

    def merge(self, run: str) -> list[int]:
        """Ids of a run of characters merged until no adjacent pair is a piece."""
        n, piece = len(run), self.piece
        size, before = [1] * n, list(range(-1, n - 1))
        heap = [(piece[run[k:k + 2]][0], k, 2) for k in range(n - 1) if run[k:k + 2] in piece]
        heapq.heapify(heap)
        while heap:
            _, at, whole = heapq.heappop(heap)
            right = at + size[at]
            if not size[at] or right >= n or size[at] + size[right] != whole:
                continue  # one of the pair has been merged otherwise
            size[at], size[right] = whole, 0
            after = at + whole
            if after < n:
                before[after] = at
                if got := piece.get(run[at:after + size[after]]):
                    heapq.heappush(heap, (got[0], at, whole + size[after]))
            if at:
                left = before[at]
                if got := piece.get(run[left:after]):
                    heapq.heappush(heap, (got[0], left, after - left))
        out, at = [], 0
        while at < n:
            if got := piece.get(run[at:at + size[at]]):
                out.append(got[1])
            else:
                out.extend(self.byte[x] for x in run[at].encode())
            at += size[at]
        return out


def piece_coder(path: str) -> PieceCoder:
    """The coder for a model: merges for BPE, else Viterbi."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    return (MergeCoder if model.trainer_spec.model_type == pb.TrainerSpec.BPE else PieceCoder)(path)


def _coder(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(model)
        spelt = np.zeros(len(coder.raw), bool)
        spelt[list(coder.byte.values())] = True
        for b in batches:
            for start in range(0, b.num_rows, 256):
                part = b.slice(start, 256)
                texts = part.column("text").to_pylist()
                ids = [None if t is None else coder.encode(t) for t in texts]
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), "ids": pa.array(ids, pa.list_(pa.int32())),
                    "n_tokens": pa.array([0 if x is None else len(x) for x in ids], pa.int64()),
                    "n_bytes": pa.array([0 if x is None else int(spelt[x].sum()) for x in ids], pa.int64()),
                    "exact": pa.array([None if x is None else coder.decode(x) == t for x, t in zip(ids, texts, strict=True)],
                                      pa.bool_())})
    return run


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids, n_tokens, n_bytes (ids that spell bytes) and exact (ids decode to the text).

    A null text has null ids and no verdict; an empty one has no ids.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(_coder(model), "doc_id long, ids array<int>, n_tokens long, n_bytes long, exact boolean")


def decode_pieces(rows: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of rows of ids; null ids give a null text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_coder(model)
        for b in batches:
            text = [None if x is None else coder.decode(np.array(x, np.int64)) for x in b.column("ids").to_pylist()]
            yield pa.record_batch({"doc_id": b.column("doc_id"), "text": pa.array(text, pa.string())})
    rows = rows.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{ids_col}`").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, text string")
