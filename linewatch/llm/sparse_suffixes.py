"""Passages that documents have in common, from sparse suffix arrays.

Of all suffixes of a text those at minimiser positions are kept: in each window of `size` words,
the run of SEED words with the smallest hash. Equal passages have equal minimisers. Suffixes are
brought together by their seed; where a seed meets another document, the windows around it are
extended left and right and compared as wholes, which finds every run of `size` words that two
documents have in common, and no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from linewatch.llm import words as W
from linewatch.llm.common import discard, prepare, staged, table

#: Words of a passage; shorter ones are left alone.
PASSAGE = 50
SEED = 8
_GROUP = ["_g1", "_g2"]


def minimisers(w: W.Words, hashes: np.ndarray, size: int, seed: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, seed hash) of each kept suffix of a slice: runs of
    windows of `size` words in one text that have the same minimiser, the leftmost of equals."""
    grams = W.window_hashes(hashes, seed)
    reach = size - seed + 1
    starts = np.flatnonzero(
        np.arange(len(hashes)) + size <= np.repeat(w.word_at[1:], np.diff(w.word_at)))
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64)
    packed = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams)).astype(np.uint64)
    span = 1
    while span * 2 <= reach:
        packed = np.minimum(packed[: len(packed) - span], packed[span:])
        span *= 2
    low = np.minimum(packed[starts], packed[starts + reach - span])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = w.text_of_word()[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return starts[first], np.diff(np.append(first, len(starts))), grams[at[first]]


def _suffixes(docs: DataFrame, size: int, seed: int) -> DataFrame:
    """A row a document with its kept suffixes: seed hashes, first windows, numbers of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.large(batch.column(3))
            for i, j in W.slices(texts):
                w = W.cut(texts[i:j])
                first, count, grams = minimisers(w, w.hashes(), size, seed)
                of = np.searchsorted(w.word_at, first, "right") - 1
                ends = pa.array(np.searchsorted(of, np.arange(j - i + 1)).astype(np.int32))
                lists = [grams.view(np.int64), (first - w.word_at[of]).astype(np.int32),
                         count.astype(np.int32)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).slice(i, j - i) for k in range(3)],
                     pa.array(np.diff(w.word_at)),
                     *[pa.ListArray.from_arrays(ends, pa.array(x)) for x in lists]],
                    ["id", *_GROUP, "n_words", "seeds", "firsts", "counts"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", *_GROUP, "text").mapInArrow(
        run, f"id {kind}, _g1 long, _g2 long, n_words long, seeds array<long>, "
             "firsts array<int>, counts array<int>")


def _extended(docs: DataFrame, size: int) -> DataFrame:
    """(passage hash, seed, id, last id, first word) of the windows around the suffixes of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = W.large(batch.column(2))
            for i, j in W.slices(texts):
                w = W.cut(texts[i:j])
                whole = W.window_hashes(w.hashes(), size)
                suffix = batch.column(3).slice(i, j - i)
                per = np.asarray(suffix.value_lengths(), np.int64)
                flat = suffix.flatten()
                first, count = (np.asarray(flat.field(k), np.int64) for k in (1, 2))
                grams = np.asarray(flat.field(0), np.int64)
                of = np.repeat(np.arange(j - i), per)
                row = np.repeat(np.arange(len(first)), count)
                within = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                at = first[row] + within
                take = pa.array(of[row] + i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(whole[at + w.word_at[of[row]]].view(np.int64)), pa.array(grams[row]),
                     batch.column(0).take(take), batch.column(1).take(take),
                     pa.array(at.astype(np.int32))], ["passage", "seed", "id", "last", "at"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "last", "text", "suffixes").mapInArrow(
        run, f"passage long, seed long, id {kind}, last {kind}, at int")


def _union(rows: DataFrame, by: list[str], size: int) -> DataFrame:
    """Unions of windows of `size` words from `at`: start_word and n_words."""
    order = Window.partitionBy(*by).orderBy("at")
    apart = F.col("at") > F.lag("at").over(order) + size
    return rows.withColumn("_new", F.coalesce(apart.cast("int"), F.lit(0))).withColumn(
        "_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ).groupBy(*by, "_run").agg(
        F.min("at").cast("long").alias("start_word"),
        (F.max("at") + size - F.min("at")).cast("long").alias("n_words")).drop("_run")


def _with_digest(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(
        F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("_g1"),
        F.xxhash64(F.lit("text"), F.col(text)).alias("_g2"), F.col(text).alias("text"))


def repeated_passages(
    docs: DataFrame, key: str, text: str, size: int = PASSAGE, seed: int = SEED,
) -> DataFrame:
    """key, start_word, n_words, first: the unions of all runs of `size` words that another
    document has too. first: this document has the smallest key of those with the run; runs of
    both kinds are joined apart. Documents without such a run have no row.

    Null and empty texts have no words; rows without a key take no part; rows of equal key and
    text are one document. Repeats inside one document are not passages. Copies of one text are
    worked on once. What is shuffled are seeds (one in some twenty words), then the texts with a
    repeated seed and their windows; counts combine before the shuffle and no group is collected.
    """
    prepare(docs.sparkSession)
    source = _with_digest(docs, key, text).where(F.col("id").isNotNull())
    arrays = ["seeds", "firsts", "counts"]
    texts = staged(_suffixes(source, size, seed).where(F.col("n_words") >= size), "suffixes")
    kinds = staged(texts.groupBy(*_GROUP).agg(
        F.min("id").alias("id"), F.max("id").alias("last"), F.first("n_words").alias("n_words"),
        *[F.first(a).alias(a) for a in arrays]), "kinds")
    copied = F.col("id") != F.col("last")
    each = kinds.select("id", "last", *_GROUP, F.explode(F.arrays_zip(*arrays)).alias("x"))
    met = each.groupBy(F.col("x.seeds").alias("seed")).agg(
        F.min("id").alias("low"), F.max("last").alias("high")).where("low <> high").select("seed")
    # a text that has copies shares all its suffixes
    close = staged(each.join(met, F.col("x.seeds") == F.col("seed"), "left_semi").groupBy(
        "id", "last", *_GROUP).agg(F.collect_list("x").alias("suffixes")), "close")
    around = staged(_extended(source.join(close, ["id", *_GROUP]), size), "windows")
    discard(close)
    known = staged(around.groupBy("passage", "seed").agg(
        F.min("id").alias("low"), F.max("last").alias("high")).where("low <> high").select(
        "passage", "seed", "low"), "known")
    runs = around.join(known, ["passage", "seed"]).select(
        "id", "at", (F.col("id") == F.col("low")).alias("first"))
    spans = _union(runs, ["id", "first"], size)
    copies = texts.select("id", *_GROUP).distinct().join(
        kinds.where(copied).select(F.col("id").alias("kept"), *_GROUP, "n_words"), _GROUP
    ).where(F.col("id") != F.col("kept")).select(
        "id", F.lit(0).cast("long").alias("start_word"), "n_words", F.lit(False).alias("first"))
    return spans.select("id", "start_word", "n_words", "first").unionByName(copies).select(
        F.col("id").alias(key), "start_word", "n_words", "first")


def without_spans(docs: DataFrame, key: str, text: str, spans: DataFrame) -> DataFrame:
    """docs without the words of spans (key, start_word, n_words), and the white space after
    them. Documents of which no word is left go; others, also empty ones, are unchanged. A key
    that several rows share cuts all of them."""
    prepare(docs.sparkSession)
    lists = spans.groupBy(F.col(key).alias("_key")).agg(
        F.collect_list(F.struct("start_word", "n_words")).alias("_spans"))
    joined = docs.join(lists, F.col(key) == F.col("_key"), "left").drop("_key")
    names = joined.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(at).to_pylist()
            gone = []
            for row, cuts in enumerate(batch.column(len(names) - 1)):
                if not cuts.is_valid or values[row] is None:
                    continue
                w = W.cut(W.large(pa.array([values[row]])))
                n = len(w.start)
                keep = np.ones(n, bool)
                for c in cuts.as_py():
                    keep[c["start_word"]: c["start_word"] + c["n_words"]] = False
                if not keep.any():
                    gone.append(row)
                    continue
                nxt = np.append(w.start[1:], len(w.data))
                edge = np.flatnonzero(np.diff(np.concatenate([[0], keep, [0]])))
                head = w.data[: w.start[0]].tobytes()
                values[row] = (head + b"".join(
                    w.data[w.start[a]: nxt[b - 1]].tobytes()
                    for a, b in edge.reshape(-1, 2))).decode()
            columns = [pa.array(values, pa.string()) if i == at else batch.column(i)
                       for i in range(len(names) - 1)]
            keep_rows = np.ones(batch.num_rows, bool)
            keep_rows[gone] = False
            yield pa.RecordBatch.from_arrays(columns, names[:-1]).filter(pa.array(keep_rows))

    return joined.mapInArrow(run, docs.schema)


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"), "doc_id", "text")


OP7_SQL = rf"""
with words as (
  select doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from documents
  where text is not null),
runs as (
  select doc_id, i - 1 as pos, array_to_string(w[i : i + {PASSAGE - 1}], ' ') as run
  from (select doc_id, w, unnest(range(1, len(w) - {PASSAGE - 2})) as i from words)),
known as (
  select run, min(doc_id) as low from runs group by run having min(doc_id) <> max(doc_id)),
hits as (select distinct doc_id, pos, doc_id = low as "first" from runs join known using (run)),
marked as (
  select *, coalesce(pos > lag(pos) over (partition by doc_id, "first" order by pos) + {PASSAGE}, false)
    as fresh from hits),
numbered as (
  select *, sum(fresh::int) over (partition by doc_id, "first" order by pos) as span from marked)
select doc_id, min(pos)::bigint as start_word, (max(pos) + {PASSAGE} - min(pos))::bigint as n_words,
       "first"
from numbered group by doc_id, "first", span
"""
