"""Language of each document, and of the spans of mixed-language text.

The script of a word narrows the languages it can be of; hashed byte trigrams score it under each;
Viterbi over the words of a text, with a penalty for every change of language, labels spans.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from linewatch.llm import words as W
from linewatch.llm.common import hinted, prepare, staged, table

#: Labelled documents of each language that the scores are learned from, at most: the bound of the
#: sample. Which ones they are follows a hash of their id.
SAMPLE = 2_000
#: So many times the sample are drawn before the smallest hashes are taken.
MARGIN = 4
#: Different labels, at most: the bound of the model and of what the driver is sent.
LANGUAGES = 1_000
#: Log-probability lost with each change of language.
SWITCH = 12.0
#: Trigrams are hashed to so many numbers.
BUCKETS = 1 << 16
#: A script belongs to a language that has at least this share of its sampled words in it.
SCRIPT_SHARE = 0.005
UNKNOWN = "und"

# First and last code point of the letters of each script.
SCRIPTS = [
    ("Latin", 0x41, 0x5A), ("Latin", 0x61, 0x7A), ("Latin", 0xC0, 0x24F),
    ("Greek", 0x370, 0x3FF), ("Cyrillic", 0x400, 0x52F), ("Armenian", 0x530, 0x58F),
    ("Hebrew", 0x590, 0x5FF), ("Arabic", 0x600, 0x6FF), ("Devanagari", 0x900, 0x97F),
    ("Bengali", 0x980, 0x9FF), ("Tamil", 0xB80, 0xBFF), ("Thai", 0xE00, 0xE7F),
    ("Georgian", 0x10A0, 0x10FF), ("Hangul", 0x1100, 0x11FF), ("Latin", 0x1E00, 0x1EFF),
    ("Greek", 0x1F00, 0x1FFF), ("Kana", 0x3040, 0x30FF), ("Han", 0x3400, 0x9FFF),
    ("Hangul", 0xAC00, 0xD7AF),
]
#: Letters outside the table are of the script "other"; it is first, so that a word with letters
#: of a listed script is of that one.
NAMES = ["", "other", *dict.fromkeys(s for s, _, _ in SCRIPTS)]
_SCRIPT = np.array(
    [unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)], np.uint8)
for _name, _low, _high in SCRIPTS:
    _SCRIPT[_low: _high + 1] = NAMES.index(_name)


#: Bytes of text that are scored together.
SLICE_BYTES = 256_000


def scripts_of_words(w: W.Words) -> np.ndarray:
    """The script of each word's letters, 0 without letters."""
    if not len(w.start):
        return np.zeros(0, np.uint8)
    b = w.data
    script = np.where(b < 0x80, _SCRIPT[b], np.uint8(0))
    lead = np.flatnonzero(b >= 0xC0)  # where a longer character begins
    if len(lead):
        one, two, three, four = (
            b[np.minimum(lead + k, len(b) - 1)].astype(np.int64) & (63 if k else 255) for k in range(4))
        point = np.where(one < 0xE0, (one & 31) << 6 | two, np.where(
            one < 0xF0, (one & 15) << 12 | two << 6 | three,
            (one & 7) << 18 | two << 12 | three << 6 | four))
        script[lead] = _SCRIPT[np.minimum(point, sys.maxunicode)]
    return np.maximum.reduceat(script, w.start)


def trigrams(w: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """(hashed trigram around each byte, whether the byte is in a word)."""
    d = W._LOWER[w.data].astype(np.uint32)
    inside = ~W._SPACE[w.data]
    d = np.concatenate([[32], np.where(inside, d, 32), [32]]).astype(np.uint32)
    h = (d[:-2] << np.uint32(16) | d[1:-1] << np.uint32(8) | d[2:]) * np.uint32(0x9E3779B1)
    return (h >> np.uint32(16)).astype(np.int64), inside


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray   # (languages, BUCKETS): log-probability of a trigram
    allowed: np.ndarray  # (scripts, languages)


def draw(key: Column | str) -> Column:
    """A number from 0 to 2^63 - 1 by the hash of a key."""
    return F.shiftrightunsigned(F.xxhash64(key), 1)


def learn(labelled: DataFrame, key: str, text: str, lang: str, sample: int = SAMPLE) -> Model:
    """A model from at most `sample` rows of each non-null language that have a text: those with the
    smallest hashes of their key. Rows of equal key and language are in the sample together."""
    prepare(labelled.sparkSession)
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(key).alias("_key"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    # rows are drawn by a hash of their key: first so many that the smallest hashes are among them,
    # then those; a language of very many rows is never ranked as a whole
    many = hinted(staged(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("_many")), "languages"))
    if many.count() > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} different labels")
    drawn = rows.select("_key", "lang", draw("_key").alias("_draw")).join(many, "lang").where(
        F.col("_draw") / float(1 << 63) * F.col("_many") < MARGIN * sample).select(
        "_key", "lang", "_draw").distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("_draw", "_key"))
    chosen = hinted(staged(drawn.withColumn("_place", place).where(
        F.col("_place") <= sample).select("_key", "lang"), "sample"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = W.large(batch.column(1)), np.array(batch.column(0).to_pylist(), object)
            for lang_ in dict.fromkeys(langs):
                total = np.zeros(BUCKETS + len(NAMES), np.int64)
                for i in np.flatnonzero(langs == lang_):
                    w = W.cut(texts[int(i): int(i) + 1])
                    gram, inside = trigrams(w)
                    total[:BUCKETS] += np.bincount(gram[inside], minlength=BUCKETS)
                    total[BUCKETS:] += np.bincount(scripts_of_words(w), minlength=len(NAMES))
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang_] * len(used)), pa.array(used), pa.array(total[used])],
                    ["lang", "gram", "n"])

    counts = rows.join(chosen, ["_key", "lang"], "left_semi").select("lang", "text").mapInArrow(
        count, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n")).toPandas()  # languages times BUCKETS rows at most
    languages = sorted(counts["lang"].unique())
    total = np.zeros((len(languages), BUCKETS + len(NAMES)))
    total[[languages.index(x) for x in counts["lang"]], counts["gram"].astype(int)] = counts["n"]
    grams, scripts = total[:, :BUCKETS], total[:, BUCKETS:]
    seen = max(int((grams.sum(0) > 0).sum()), 1)
    scores = np.log((grams + 0.5) / (grams.sum(1, keepdims=True) + 0.5 * seen))
    share = scripts / np.maximum(scripts[:, 1:].sum(1, keepdims=True), 1)
    allowed = (share >= SCRIPT_SHARE).T
    allowed[0] = False
    return Model(languages, scores.astype(np.float32), allowed)


def word_scores(w: W.Words, model: Model, script: np.ndarray | None = None) -> np.ndarray:
    """(words, languages); all 0 where no language has the word's script."""
    n = len(w.start)
    out = np.zeros((n, len(model.languages)), np.float32)
    if not n:
        return out
    gram, inside = trigrams(w)
    for k in range(len(model.languages)):
        out[:, k] = np.add.reduceat(np.where(inside, model.scores[k][gram], np.float32(0)), w.start)
    may = model.allowed[scripts_of_words(w) if script is None else script]
    any_ = may.any(1)
    out[~any_] = 0
    out[any_[:, None] & ~may] = -1e4
    return out


def viterbi(scores: np.ndarray, word_at: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language of each word; texts are worked on side by side, a word at a time."""
    sizes = np.diff(word_at)
    lanes = np.argsort(-sizes, kind="stable")
    first, sizes = word_at[:-1][lanes], sizes[lanes]
    kind = np.int8 if scores.shape[1] <= 127 else np.int16
    label = np.zeros(len(scores), kind)
    if not len(sizes) or not sizes[0]:
        return label
    active = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")  # texts longer than t
    state = np.zeros((len(sizes), scores.shape[1]), np.float32)
    own = np.arange(scores.shape[1], dtype=kind)
    back = []
    for t, k in enumerate(active):
        s = state[:k]
        top = s.argmax(1)
        change = s[np.arange(k), top][:, None] - np.float32(switch)
        stays = s >= change
        back.append(np.where(stays, own, top[:, None].astype(kind)))
        state[:k] = np.where(stays, s, change) + scores[first[:k] + t]
    now = state.argmax(1).astype(kind)
    for t in range(len(active) - 1, -1, -1):
        k = active[t]
        label[first[:k] + t] = now[:k]
        now[:k] = back[t][np.arange(k), now[:k]]
    return label


def predicted(docs: DataFrame, text: str, model: Model, switch: float = SWITCH) -> DataFrame:
    """docs with lang_pred, score (share of the bytes of words with letters that is in it) and
    spans (lang, start_word, n_words). Words in letters outside the table of scripts count if a
    learned language has such letters, else they have no weight. Null texts, texts without a letter, and every text if
    nothing was learned: `und`, 0 and no spans. Columns of these names are replaced."""
    prepare(docs.sparkSession)
    made = ("lang_pred", "score", "spans")
    names = [c for c in docs.columns if c not in made]
    source = docs.select(
        *names, (F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))).alias("_letters"))
    at, languages = names.index(text), model.languages
    least = 1 if model.allowed[NAMES.index("other")].any() else 2
    span = pa.struct([("lang", pa.string()), ("start_word", pa.int32()), ("n_words", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            texts = W.large(batch.column(at))
            parts, scores, weight = [], [], []
            for i, j in W.slices(texts, SLICE_BYTES):
                w = W.cut(texts[i:j])
                script = scripts_of_words(w)
                parts.append(np.diff(w.word_at))
                scores.append(word_scores(w, model, script))
                weight.append(np.where(script >= least, w.end - w.start, 0))
            word_at = np.concatenate([[0], np.cumsum(np.concatenate(parts))])
            weight = np.concatenate(weight)
            label = viterbi(np.concatenate(scores), word_at, switch) if languages else \
                np.zeros(len(weight), np.int64)
            of = np.repeat(np.arange(n), np.diff(word_at))
            k = max(len(languages), 1)
            mass = np.bincount(of * k + label, weight, n * k).reshape(n, k)
            best, total = mass.argmax(1), mass.sum(1)
            ok = np.asarray(batch.column(len(names)).to_numpy(zero_copy_only=False), bool) & bool(languages)
            new = np.ones(len(label), bool)
            new[1:] = (label[1:] != label[:-1]) | (of[1:] != of[:-1])
            new &= ok[of]
            first = np.flatnonzero(new)
            ends = np.minimum(np.append(first[1:], len(label)), word_at[1:][of[first]])
            spans = pa.StructArray.from_arrays([
                pa.array([languages[x] for x in label[first]], pa.string()),
                pa.array((first - word_at[of[first]]).astype(np.int32)),
                pa.array((ends - first).astype(np.int32))], fields=list(span))
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(of[first], np.arange(n + 1)).astype(np.int32)), spans)
            share = np.where(ok & (total > 0), mass[np.arange(n), best] / np.maximum(total, 1), 0.0)
            pred = [languages[b] if o else UNKNOWN for b, o in zip(best, ok, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(names))], pa.array(pred), pa.array(share),
                 lists], [*names, *made])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1])
    return source.mapInArrow(
        run, f"{fields}, lang_pred string, score double, "
             "spans array<struct<lang:string,start_word:int,n_words:int>>")


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op8_span_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out("doc_id")), "doc_id", "text", "lang")
    return predicted(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"),
                     "text", model).select("doc_id", "held_out", "lang_pred", "score", "spans")
