"""Token ids of texts by the tokenizers library, with every different word encoded once a batch."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words are cut at blanks and line feeds; a text with other white space, or with the start of a
# special token, is encoded as it is.
_UNUSUAL = re.compile("[^\\S \\n]|\u180e|<\\|")
#: A word of letters of Western Europe between marks, which the `word` kind cuts into these three
#: and puts into lower case a letter at a time.
_PLAIN = r'^(?P<before>[-.,;:!?*()"]*)(?P<letters>[a-zA-ZÀ-ÖØ-öø-ÿ]*)(?P<after>[-.,;:!?*()"]*)$'
_END_OF_WORD = "</w>"
#: Different words that are encoded as one text; longer texts take longer a word.
TOGETHER = 200
#: Words, and their parts, an encoder remembers before it starts anew; only speed depends on it.
REMEMBERED, REMEMBERED_PARTS = 400_000, 800_000


def vocabulary(path: str) -> bytes:
    """A tokenizer file as bytes, which travel with the function: executors need no copy."""
    with open(path, "rb") as f:
        return f.read()


def _tokenizer(data: bytes):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_buffer(data)


def _is_usual(text: str) -> bool:
    # of white space only the blank is printable, so most texts need no search
    if "<|" not in text and text.replace("\n", " ").isprintable():
        return True
    return not _UNUSUAL.search(text)


def _chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts, how many each text has): white space of blanks and line feeds belongs to
    the word after it, and what ends a text is a word of its own."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1] if len(texts) else \
        np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[: offsets[-1]]
    white = (data == 0x20) | (data == 0x0A)
    begins = np.zeros(len(data) + 1, bool)
    begins[1:-1] = white[1:] & ~white[:-1]
    begins[offsets] = True  # the last is the end
    at = np.flatnonzero(begins)
    return pa.LargeStringArray.from_buffers(
        len(at) - 1, pa.py_buffer(at), pa.py_buffer(data)), np.diff(np.searchsorted(at, offsets))


class _Numbers(dict):
    """The next number for a word not seen before."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


class _Known:
    """Words with numbers from 0, and their ids one after the other."""

    def __init__(self) -> None:
        self.number = _Numbers()
        self.ids, self.at = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def add(self, ids: np.ndarray, at: np.ndarray) -> None:
        self.at = np.concatenate([self.at[:-1], at + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words of these numbers, how many each has)."""
        size = np.diff(self.at)[codes]
        run = np.cumsum(size) - size
        return self.ids[np.arange(int(size.sum())) + np.repeat(self.at[:-1][codes] - run, size)], size


class Encoder:
    """kind: `byte`, where blanks belong to the word after them, or `word`, where they are dropped;
    in both no token reaches over the start of white space. separator: a special token of the
    file, which ends a word wherever it stands."""

    def __init__(self, data: bytes, kind: str, separator: str):
        self.tokenizer, self.kind = _tokenizer(data), kind
        self.separator, self.id = separator, self.tokenizer.token_to_id(separator)
        # where the last token of a word says so, blanks between words do
        self.ends: np.ndarray | None = None
        if kind == "word" and json.loads(data)["model"].get("end_of_word_suffix") == _END_OF_WORD:
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.ends[[n for token, n in self.tokenizer.get_vocab().items()
                       if token.endswith(_END_OF_WORD)]] = True
        # where a token's characters stand for bytes, these say where a word ends
        self.bytes: np.ndarray | None = None
        if kind == "byte" and (json.loads(data)["pre_tokenizer"] or {}).get("type") == "ByteLevel":
            self.bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
            for token, n in self.tokenizer.get_vocab().items():
                self.bytes[n] = len(token)
        self._forget()

    def _forget(self) -> None:
        self.words, self.parts = _Known(), _Known()

    @property
    def number(self) -> dict[str, int]:
        return self.words.number

    @property
    def ids(self) -> np.ndarray:
        return self.words.ids

    def _encoded(self, words: list[str], between: str) -> np.ndarray:
        """Ids of words with a separator after each."""
        texts = [between.join(words[i: i + TOGETHER]) + between
                 for i in range(0, len(words), TOGETHER)]
        ids = [np.array(e.ids, np.uint32)
               for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(ids) if ids else np.zeros(0, np.uint32)

    def _whole(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, where each word's ids begin, and the end)."""
        flat = self._encoded(words, self.separator)
        ends = np.flatnonzero(flat == self.id)
        at = np.concatenate([[0], ends - np.arange(len(ends))])
        return np.delete(flat, ends), at

    def _runs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words that are either letters or marks alone: each ends at one token."""
        flat = self._encoded(words, " ")
        ends = np.flatnonzero(self.ends[flat])
        if len(ends) != len(words):
            return self._whole(words)
        return flat, np.concatenate([[0], ends + 1])

    def _following(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words that begin with white space and have more: they follow one another as
        they are and are told apart by the bytes of their tokens."""
        flat = self._encoded(words, "")
        ends = np.concatenate([[0], np.cumsum(self.bytes[flat])])
        sizes = np.asarray(pc.binary_length(pa.array(words, pa.string())), np.int64)
        wanted = np.concatenate([[0], np.cumsum(sizes)])
        at = np.searchsorted(ends, wanted)
        if at[-1] != len(flat) or (ends[at] != wanted).any():
            return self._whole(words)
        return flat, at

    def _with_odd(self, words: list[str], odd: np.ndarray, flat: np.ndarray, first: np.ndarray,
                  ) -> tuple[np.ndarray, np.ndarray]:
        """The same of words of which the odd ones have no ids yet."""
        if not len(odd):
            return flat, first
        known, total = _Known(), np.diff(first)
        known.add(flat, first)
        whole, at = self._whole([words[i] for i in odd])
        known.add(whole, at)
        order = np.arange(len(words))
        order[odd] = len(words) + np.arange(len(odd))
        total[odd] = np.diff(at)
        return known.of(order)[0], np.concatenate([[0], np.cumsum(total)])

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of any words: those of letters and marks out of their parts."""
        if self.bytes is not None:
            plain = np.array([w[0] in " \n" and not w.isspace() for w in words], bool)
            flat, at = self._following([w for w, p in zip(words, plain.tolist(), strict=True) if p])
            first = at[np.concatenate([[0], np.cumsum(plain)])]
            return self._with_odd(words, np.flatnonzero(~plain), flat, first)
        if self.ends is None:
            return self._whole(words)
        cut = pc.extract_regex(pa.array(words, pa.string()), _PLAIN)
        odd = np.flatnonzero(np.asarray(cut.is_null()))
        before, letters, after = (pc.struct_field(cut, f) for f in ("before", "letters", "after"))
        parts = pa.concat_arrays([before, pc.utf8_lower(letters), after]).dictionary_encode()
        if len(self.parts.number) > REMEMBERED_PARTS:
            self.parts = _Known()
        number, seen = self.parts.number, len(self.parts.number)
        codes = np.array([number[p] if p else -1 for p in parts.dictionary.to_pylist()] + [-1])
        codes = codes[np.asarray(parts.indices.fill_null(len(codes) - 1))].reshape(3, -1).T
        count = (codes >= 0).sum(1)
        self.parts.add(*self._runs(list(islice(number, seen, None))))
        flat, size = self.parts.of(codes[codes >= 0])
        first = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(count)])]
        return self._with_odd(words, odd, flat, first)

    def encode(self, texts: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids begin, and the end), `end` after each text."""
        try:
            return self._encode(texts, end)
        except BaseException:  # words that got a number may not have ids yet
            self._forget()
            raise

    def _chunks(self, usual: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(the number of each chunk, how many each text has)."""
        number = self.words.number
        # of white space there are blanks and line feeds only
        texts = pa.array(usual, pa.large_string())
        if self.kind == "byte":
            chunks, count = _chunks(texts)
            words = chunks.dictionary_encode()
        else:  # an empty word has no ids
            lists = pc.ascii_split_whitespace(texts)
            words = lists.flatten().dictionary_encode()
            count = np.asarray(pc.list_value_length(lists), np.int64)
        own = words.dictionary.to_pylist()
        codes = np.fromiter(map(number.__getitem__, own), np.int64, len(own))
        return codes[np.asarray(words.indices)], count

    def _encode(self, texts: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        odd = [i for i, t in enumerate(texts) if not _is_usual(t)]
        if len(self.words.number) > REMEMBERED:
            self.words = _Known()
        seen = len(self.words.number)
        strange = set(odd)
        codes, count = self._chunks([t for i, t in enumerate(texts) if i not in strange])
        self.words.add(*self._words(list(islice(self.words.number, seen, None))))
        whole = dict(zip(odd, self.tokenizer.encode_batch_fast(
            [texts[i] for i in odd], add_special_tokens=False) if odd else (), strict=True))
        flat, out_size = self.words.of(codes)
        total = np.concatenate([[0], np.cumsum(out_size)])
        chunks = np.zeros(len(texts), np.int64)
        chunks[[i for i in range(len(texts)) if i not in strange]] = count
        n_chunks = np.concatenate([[0], np.cumsum(chunks)])
        parts, sizes, last = [], [], np.array([end], np.uint32)
        for i in range(len(texts)):
            own = np.array(whole[i].ids, np.uint32) if i in whole else \
                flat[total[n_chunks[i]]: total[n_chunks[i + 1]]]
            parts += [own, last]
            sizes.append(len(own) + 1)
        return (np.concatenate(parts) if parts else np.zeros(0, np.uint32),
                np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))


_kept: dict[tuple[bytes, str, str], Encoder] = {}


def encoder(data: bytes, kind: str, separator: str) -> Encoder:
    """The encoder of this worker process: its tasks, which run one after the other, read the file
    once and share the words they remember."""
    key = (data, kind, separator)
    if key not in _kept:
        _kept.clear()
        _kept[key] = Encoder(*key)
    return _kept[key]


def batches_of(texts: list[str | None], characters: int = 4_000_000) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of some millions of characters each, or one text; nulls are empty."""
    at, n = 0, 0
    for i, t in enumerate(texts):
        if i > at and n + len(t or "") > characters:
            yield at, [x or "" for x in texts[at:i]]
            at, n = i, 0
        n += len(t or "")
    if texts:
        yield at, [x or "" for x in texts[at:]]
