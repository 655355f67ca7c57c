"""Repetition inside a text, from a suffix array over its words.

Suffix arrays of all texts of a slice are built at once by prefix doubling: words are ranked by
hash within their text, then runs of 2, 4, 8 ... words, and only suffixes that still share their
rank are sorted again. The kept ranks give the longest common prefix of neighbours. A suffix whose
prefix of n words is shared with a neighbour opens a maximal repeated substring of n words (the
deepest interval of common prefixes it lies in), and the union of these spans is what repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from linewatch.llm import words as W
from linewatch.llm.common import prepare, table

#: Repeats shorter than this many words are ordinary language.
MIN_REPEAT = 10
#: A text fails when more than this share of its words lies in repeats ...
MAX_COVERED = 0.3
#: ... or when its longest repeat is more than this share of its words.
MAX_LONGEST = 0.2
#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 50, 50, 3


def suffix_array(symbols: np.ndarray, text: np.ndarray, left: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, common prefix with the one before) of all texts of a slice.

    symbols: a number for each word; text: the text it lies in, ascending; left: words from it to
    the end of its text. Suffixes of different texts share nothing.
    """
    n = len(symbols)
    order = np.lexsort((symbols, text))
    s, t = symbols[order], text[order]
    head = np.ones(n, bool)
    head[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    levels, step = [rank.copy()], 1
    tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    while len(tied):
        after = np.where(left[tied] > step, rank[np.minimum(tied + step, n - 1)] + 1, 0)
        by = np.argsort(rank[tied] * (n + 1) + after, kind="stable")
        tied, after, old = tied[by], after[by], rank[tied[by]]
        first = np.ones(len(tied), bool)
        first[1:] = old[1:] != old[:-1]
        new = first.copy()
        new[1:] |= after[1:] != after[:-1]
        at = np.arange(len(tied))
        rank[tied] = old + np.maximum.accumulate(np.where(new, at, 0)) \
            - np.maximum.accumulate(np.where(first, at, 0))
        step *= 2
        levels.append(rank.copy())
        size = np.diff(np.append(np.flatnonzero(new), len(tied)))
        tied = tied[np.repeat(size > 1, size)]
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    a, b = suffixes[:-1].copy(), suffixes[1:].copy()
    common = np.zeros(n, np.int64)
    live = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b = a[live], b[live]
    for k in range(len(levels) - 1, -1, -1):
        # equal ranks stand for equal runs only while both runs end inside the text
        fits = (a < n) & (b < n)
        same = fits & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)]) \
            & (text[np.minimum(a, n - 1)] == text[np.minimum(suffixes[:-1][live], n - 1)]) \
            & (text[np.minimum(b, n - 1)] == text[np.minimum(suffixes[1:][live], n - 1)])
        a, b = a + same * (1 << k), b + same * (1 << k)
        common[live + 1] += same * (1 << k)
    return suffixes, common


def repeats(w: W.Words, min_repeat: int) -> dict[str, np.ndarray]:
    """For each word of a slice, `length` of the longest repeated run that opens there (0: below
    min_repeat), and `covered`, whether any such run covers it."""
    n = len(w.start)
    if n == 0:
        return {"length": np.zeros(0, np.int64), "covered": np.zeros(0, bool)}
    text = w.text_of_word()
    symbols = np.unique(w.hashes(), return_inverse=True)[1]
    left = w.word_at[1:][text] - np.arange(n)
    suffixes, common = suffix_array(symbols, text, left)
    best = np.maximum(common, np.append(common[1:], 0))
    length = np.empty(n, np.int64)
    length[suffixes] = np.where(best >= min_repeat, best, 0)
    steps = np.zeros(n + 1, np.int64)
    opens = np.flatnonzero(length)
    np.add.at(steps, opens, 1)
    np.add.at(steps, opens + length[opens], -1)
    return {"length": length, "covered": np.cumsum(steps[:-1]) > 0}


def spans(w: W.Words, min_repeat: int = MIN_REPEAT) -> list[tuple[int, int, int]]:
    """(text, first word, words) of the union of all repeats."""
    c = np.concatenate([[False], repeats(w, min_repeat)["covered"], [False]])
    text = np.concatenate([[-1], w.text_of_word(), [-1]])
    cut = (c[1:] != c[:-1]) | (text[1:] != text[:-1])
    edge = np.flatnonzero(cut)
    return [(int(text[i + 1]), int(i - w.word_at[text[i + 1]]), int(j - i))
            for i, j in zip(edge[:-1], edge[1:], strict=True) if c[i + 1]]


def _per_text(w: W.Words, value: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(value, dtype=np.int64)])
    return total[w.word_at[1:]] - total[w.word_at[:-1]]


def _repeat_words(w: W.Words, hashes: np.ndarray) -> np.ndarray:
    """Words in windows of WINDOW words that the text has twice or more."""
    at, h = W.windows(w, hashes, WINDOW)
    twice = np.zeros(len(w.start) + WINDOW, bool)
    if len(at):
        order = np.lexsort((h, w.text_of_word()[at]))
        t, g = w.text_of_word()[at][order], h[order]
        same = (g[1:] == g[:-1]) & (t[1:] == t[:-1])
        hit = at[order][np.append(same, False) | np.insert(same, 0, False)]
        for k in range(WINDOW):
            twice[hit + k] = True
    return _per_text(w, twice[: len(w.start)])


def _duplicate_lines(w: W.Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    n = len(w.text_at) - 1
    breaks = np.flatnonzero(w.data == 10)
    start = np.concatenate([w.text_at[:-1], breaks + 1])
    text = np.concatenate([np.arange(n), np.searchsorted(w.text_at, breaks, "right") - 1])
    by = np.lexsort((start, text))
    start, text = start[by], text[by]
    end = np.append(start[1:] - 1, len(w.data))
    last = np.append(text[1:] != text[:-1], True) if len(text) else np.zeros(0, bool)
    end[last] = w.text_at[1:][text[last]]
    worded = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end, text = start[worded], end[worded], text[worded]
    h = w.span_hash(start, end)
    by = np.lexsort((h, text))
    same = (h[by][1:] == h[by][:-1]) & (text[by][1:] == text[by][:-1])
    return np.bincount(text[by][1:][same], minlength=n)


def profile(texts: pa.Array, min_repeat: int = MIN_REPEAT) -> dict[str, np.ndarray]:
    """Counts for each text of a column made by words.large()."""
    parts: dict[str, list[np.ndarray]] = {}
    symbol = np.zeros(256, np.int64)
    symbol[list(SYMBOLS)] = 1
    for i, j in W.slices(texts):
        w = W.cut(texts[i:j])
        found = repeats(w, min_repeat)
        chars = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80, dtype=np.int64)])
        marks = np.concatenate([[0], np.cumsum(symbol[w.data])])
        longest = np.zeros(j - i, np.int64)
        np.maximum.at(longest, w.text_of_word(), found["length"])
        for name, value in {
            "n_words": np.diff(w.word_at),
            "word_chars": _per_text(w, chars[w.end] - chars[w.start]),
            "n_symbols": np.diff(marks[w.text_at]),
            "n_dup_lines": _duplicate_lines(w),
            "n_repeat_words": _repeat_words(w, w.hashes()),
            "covered_words": _per_text(w, found["covered"]),
            "longest_repeat": longest,
        }.items():
            parts.setdefault(name, []).append(value)
    return {k: np.concatenate(v).astype(np.int64) for k, v in parts.items()}


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "covered_words", "longest_repeat")


def repetition(
    docs: DataFrame, key: str, text: str, min_repeat: int = MIN_REPEAT,
    max_covered: float = MAX_COVERED, max_longest: float = MAX_LONGEST,
) -> DataFrame:
    """A row for each row of docs: key, the counts, base_failed and kept.

    Null and empty texts have no words and fail the base rules. Repeated rows give repeated rows.
    Texts are looked at whole, in their own task, without a shuffle; a slice of two megabytes, or
    one text, is in memory at a time.
    """
    prepare(docs.sparkSession)
    names = list(COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                counts = profile(W.large(batch.column(1)), min_repeat)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(counts[c]) for c in names]], ["_key", *names])

    source = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    schema = f"_key {source.schema['_key'].dataType.simpleString()}, " + ", ".join(
        f"{c} long" for c in names)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    passed = (F.col("covered_words") <= max_covered * F.col("n_words")) & (
        F.col("longest_repeat") <= max_longest * F.col("n_words"))
    return source.mapInArrow(run, schema).select(
        F.col("_key").alias(key), *names, failed.alias("base_failed"),
        (~failed & passed).alias("kept"))


def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = repetition(table(spark, sf_dir, "documents"), "doc_id", "text")
    return got.select("doc_id", *COUNTS[:5], "base_failed", "kept", *COUNTS[5:])
