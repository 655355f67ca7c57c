"""SentencePiece encoding and decoding by one pass of an Aho-Corasick automaton.

The automaton over all pieces reads a word a character at a time. At each position the output
links of its state name the pieces that end there, longest first; each relaxes the best score up
to this position. The best segmentation is then read backwards. Words are cut where white space
begins, which no piece crosses, every different word of a batch is segmented once, and all of them
side by side as numpy vectors.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from linewatch.llm import tokens
from linewatch.llm.common import prepare, table

SPACE = "▁"
#: How much an unknown character costs more than the worst piece.
UNKNOWN_PENALTY = 10.0
#: Words remembered before starting anew, and words segmented side by side; for speed only.
REMEMBERED, TOGETHER = 400_000, 50_000
_WORD = re.compile(" +[^ ]*")


@dataclass
class Pieces:
    text: list[str]        # of each id
    score: list[float]
    ordinary: list[bool]   # may be matched in text
    byte: dict[int, int]   # id of each byte value


def load(path: str) -> Pieces:
    """The pieces of a model file."""
    from sentencepiece import SentencePieceProcessor

    m = SentencePieceProcessor(model_file=path)
    ids = range(m.get_piece_size())
    text = [m.id_to_piece(i) for i in ids]
    special = [m.is_control(i) or m.is_unknown(i) or m.is_unused(i) or m.is_byte(i) for i in ids]
    byte = {int(text[i][3:5], 16): i for i in ids if m.is_byte(i)}
    if len(byte) != 256 or any(SPACE in t.lstrip(SPACE) for t in text):
        raise ValueError("a model with all byte pieces and no piece across words is needed")
    return Pieces(text, [m.get_score(i) for i in ids], [not s for s in special], byte)


class Automaton:
    """States are prefixes of pieces; state 0 is the empty one."""

    def __init__(self, pieces: Pieces):
        children: list[dict[str, int]] = [{}]
        depth, piece = [0], [-1]
        for i, (t, ok) in enumerate(zip(pieces.text, pieces.ordinary, strict=True)):
            if not ok:
                continue
            s = 0
            for c in t:
                nxt = children[s].get(c)
                if nxt is None:
                    nxt = children[s][c] = len(children)
                    children.append({})
                    depth.append(depth[s] + 1)
                    piece.append(-1)
                s = nxt
            piece[s] = i
        fail, link, queue = [0] * len(children), [0] * len(children), deque([0])
        while queue:
            s = queue.popleft()
            for c, child in children[s].items():
                f = fail[s]
                while f and c not in children[f]:
                    f = fail[f]
                fail[child] = children[f].get(c, 0) if s else 0
                f = fail[child]
                link[child] = f if piece[f] >= 0 else link[f]
                queue.append(child)
        codes = {c: k + 1 for k, c in enumerate(sorted({c for ch in children for c in ch}))}
        self.width = len(codes) + 1
        edges = sorted((s * self.width + codes[c], child)
                       for s, ch in enumerate(children) for c, child in ch.items())
        self.keys = np.array([k for k, _ in edges], np.int64)
        self.next = np.array([v for _, v in edges], np.int64)
        self.fail, self.link = np.array(fail), np.array(link)
        self.depth, self.piece = np.array(depth), np.array(piece)
        self.score = np.where(self.piece >= 0, np.array(pieces.score)[self.piece], -np.inf)
        self.unknown = min(s for s, ok in zip(pieces.score, pieces.ordinary, strict=True) if ok) \
            - UNKNOWN_PENALTY
        # a blank is read as the space sign; the sign itself, in a text, as an unknown character
        self.code = np.zeros(0x110000, np.int32)
        for c, k in codes.items():
            self.code[ord(c)] = k
        self.code[32], self.code[ord(SPACE)] = self.code[ord(SPACE)], 0
        self.single = np.zeros(self.width, bool)
        for c, child in children[0].items():
            self.single[codes[c]] = piece[child] >= 0

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        out, todo = np.zeros(len(state), np.int64), np.arange(len(state))
        while len(todo):
            key = state * self.width + code
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            out[todo[hit]] = self.next[at[hit]]
            on = ~hit & (state > 0)
            todo, state, code = todo[on], self.fail[state[on]], code[on]
        return out

    def segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of all words, where each word's begin, and the end): a piece id, or minus the
        code point of an unknown character."""
        size = np.array([len(w) for w in words])
        order = np.argsort(-size, kind="stable")
        size = size[order]
        point = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        first = (np.cumsum([0, *map(len, words)])[:-1])[order]
        most, n = int(size[0]), len(words)
        best = np.full((most + 1, n), -np.inf)
        best[0] = 0
        token, length = np.zeros((most + 1, n), np.int64), np.ones((most + 1, n), np.int32)
        state = np.zeros(n, np.int64)
        for t in range(most):
            k = int(np.searchsorted(-size, -t, "left"))
            char = point[first[:k] + t].astype(np.int64)
            code = self.code[char].astype(np.int64)
            state[:k] = at = self.step(state[:k], code)
            top, tok, ln = np.full(k, -np.inf), -char, np.ones(k, np.int32)
            lost = ~self.single[code]
            top[lost] = best[t, :k][lost] + self.unknown
            at = np.where(self.piece[at] >= 0, at, self.link[at])
            live = np.flatnonzero(at)
            at = at[live]
            while len(live):
                d = self.depth[at]
                score = best[t + 1 - d, live] + self.score[at]
                better = score > top[live]
                won = live[better]
                top[won], tok[won], ln[won] = score[better], self.piece[at[better]], d[better]
                at = self.link[at]
                live, at = live[at > 0], at[at > 0]
            best[t + 1, :k], token[t + 1, :k], length[t + 1, :k] = top, tok, ln
        at, lanes, found = size.copy(), np.arange(n), []
        while len(lanes):
            found.append((lanes, token[at, lanes]))
            at = at - length[at, lanes]
            lanes, at = lanes[at > 0], at[at > 0]
        lane = np.concatenate([a for a, _ in found])
        step = np.repeat(np.arange(len(found)), [len(a) for a, _ in found])
        value = np.concatenate([b for _, b in found])
        by = np.lexsort((-step, order[lane]))
        return value[by], np.concatenate([[0], np.cumsum(np.bincount(order[lane], minlength=n))])


class Encoder:
    def __init__(self, pieces: Pieces):
        self.automaton, self.byte = Automaton(pieces), pieces.byte
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.at = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _learn(self, words: list[str]) -> None:
        for i in range(0, len(words), TOGETHER):
            part = words[i: i + TOGETHER]
            value, at = self.automaton.segment(part)
            odd = np.flatnonzero(value <= 0)
            if len(odd):  # unknown characters as their bytes
                spelled = [[self.byte[b] for b in chr(-v).encode("utf-8", "surrogatepass")]
                           if v <= 0 else [v] for v in value.tolist()]
                size = np.array([len(s) for s in spelled])
                at = np.concatenate([[0], np.cumsum(size)])[at]
                value = np.array([x for s in spelled for x in s], np.int64)
            self.at = np.concatenate([self.at[:-1], at + len(self.ids)])
            self.ids = np.concatenate([self.ids, value])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's begin, and the end). An empty text has none."""
        if len(self.number) > REMEMBERED:
            self._forget()
        rows = [_WORD.findall(" " + t) if t else () for t in texts]
        number, seen = self.number, len(self.number)
        codes = np.array([number.setdefault(w, len(number)) for row in rows for w in row], np.int64)
        self._learn(list(islice(number, seen, None)))
        size = np.diff(self.at)[codes]
        run = np.cumsum(size) - size
        ids = self.ids[np.arange(int(size.sum())) + np.repeat(self.at[:-1][codes] - run, size)]
        words = np.cumsum([0, *map(len, rows)])
        return ids, np.concatenate([[0], np.cumsum(size)]).astype(np.int64)[words]


class Decoder:
    def __init__(self, pieces: Pieces):
        self.raw = [t.replace(SPACE, " ").encode() for t in pieces.text]
        for value, i in pieces.byte.items():
            self.raw[i] = bytes([value])

    def decode(self, ids: list[int]) -> str:
        raw = self.raw
        return b"".join([raw[i] for i in ids])[1:].decode("utf-8", "replace")


def encoded(docs: DataFrame, key: str, text: str, pieces: Pieces) -> DataFrame:
    """key and ids of each row; null and empty texts have none. Repeated rows stay."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(pieces)
        for batch in batches:
            for row, texts in tokens.batches_of(batch.column(1).to_pylist()):
                ids, at = encoder.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(texts)), pa.ListArray.from_arrays(
                        pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))],
                    ["id", "ids"])

    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", key)


def decoded(rows: DataFrame, key: str, ids: str, pieces: Pieces) -> DataFrame:
    """key, ids and text of each row; no ids are the empty text."""
    prepare(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(pieces)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([decoder.decode(x or []) for x in batch.column(1).to_pylist()])],
                ["id", "ids", "text"])

    source = rows.select(F.col(key).alias("id"), F.col(ids).alias("ids"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, ids array<int>, text string").withColumnsRenamed(
        {"id": key, "ids": ids})


def op4_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and checksums of the ids and of the text decoded from them."""
    import public_tokenizers

    pieces = load(public_tokenizers.path("piece_bpe_32k.model"))
    ids = encoded(table(spark, sf_dir, "documents"), "doc_id", "text", pieces)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten().to_numpy().astype("<i4").tobytes()
            size = np.asarray(lists.value_lengths(), np.int64)
            ends = np.cumsum(size)
            crc = [zlib.crc32(flat[4 * a: 4 * b])
                   for a, b in zip((ends - size).tolist(), ends.tolist(), strict=True)]
            text = [zlib.crc32(t.encode()) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(crc, pa.int64()),
                 pa.array(text, pa.int64())], ["doc_id", "n_tokens", "ids_crc32", "text_crc32"])

    return decoded(ids, "doc_id", "ids", pieces).mapInArrow(
        digest, "doc_id long, n_tokens long, ids_crc32 long, text_crc32 long")
