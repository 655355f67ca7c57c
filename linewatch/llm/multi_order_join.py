"""Documents whose sets of word shingles have a Jaccard similarity of a percentage or more.

Multiple-global-order prefix filtering. All shingles stand in several total orders; if two sets
reach the similarity, they share a shingle among the first few of each set, under every order.
Documents that share a prefix shingle under the first order are candidates. A prefix longer by some
shingles must share as many more; candidates that do not under one of the other orders are
dropped, and what is left is verified on whole sets.

In every order shingles known to be frequent come last, so passages that many documents share are
in hardly any prefix. Documents of equal sets are one class and take part once. A shingle in the
prefix of very many classes does not give all their pairs but a chain. What candidates connect is
verified together, in blocks of bounded size: each text is sent there once, and a block gives no
more links than it takes to connect what is similar.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from linewatch.llm import words as W
from linewatch.llm.common import components, discard, hinted, prepare, staged, table

#: So many of the shingles that are in most prefixes at first, by their upper 32 bits, go to all
#: tasks with their counts, 4 MB. This bounds what the order knows; any order gives the same result.
KNOWN_SHINGLES = 1 << 19
#: A prefix shingle in more classes than this gives a chain of candidates instead of all pairs.
CROWD = 24
#: Shingles of the sets of one block.
BLOCK_SHINGLES = 500_000
_SEEDS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0,
                   0x082EFA98EC4E6C89], np.uint64)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each slice of a column made by words.large(): (set of each shingle, shingle hashes).

    Sets are numbered from 0 over the column, each ascending without repeats. Fewer words than
    `size` are one shingle as a whole; no word, no shingle.
    """
    for i, j in W.slices(texts):
        w = W.cut(texts[i:j], lower=True)
        hashes = w.hashes()
        at, h = W.windows(w, hashes, size)
        of = w.text_of_word()[at]
        count = np.diff(w.word_at)
        short = np.flatnonzero((count > 0) & (count < size))
        whole = [W.window_hashes(hashes[a:b], b - a) for a, b in
                 zip(w.word_at[short], w.word_at[short + 1], strict=True)]
        of = np.concatenate([of, short])
        h = np.concatenate([h, *whole]) if whole else h
        by = np.lexsort((h, of))
        of, h = of[by], h[by]
        new = np.ones(len(h), bool)
        new[1:] = (of[1:] != of[:-1]) | (h[1:] != h[:-1])
        yield of[new] + i, h[new]


def _bounds(of: np.ndarray, n: int) -> np.ndarray:
    return np.searchsorted(of, np.arange(n + 1))


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - (n * percent + 99) // 100 + 1, 0)


def shared_length(prefix: np.ndarray | Column) -> np.ndarray | Column:
    """Similar sets share that many of their prefixes that are longer by so many, less one."""
    return prefix // 2 + 1 if isinstance(prefix, np.ndarray) else F.floor(prefix / 2) + 1


def order_key(h: np.ndarray, order: int, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The place of each shingle in one of the global orders: frequent ones last, known by their
    upper 32 bits."""
    key = W.mixed(h ^ _SEEDS[order]) >> np.uint64(2)
    if len(known):
        upper = (h >> np.uint64(32)).astype(np.uint32)
        at = np.minimum(np.searchsorted(known, upper), len(known) - 1)
        frequent = known[at] == upper
        level = np.minimum(counts[at], (1 << 31) - 1).astype(np.uint64)
        if order:
            level = np.log2(level + np.uint64(1)).astype(np.uint64)
        late = (np.uint64(1) << np.uint64(63)) | (level << np.uint64(31)) \
            | (W.mixed(h ^ _SEEDS[order]) >> np.uint64(33))
        key = np.where(frequent, late, key)
    return key


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def _lists(at: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), values)


def _prefixes(docs: DataFrame, size: int, percent: int, orders: int,
              known: np.ndarray, counts: np.ndarray) -> DataFrame:
    """(id, n, digest, prefix under each order) with p0 as shingles, the others, longer
    by shared_length - 1, as 16 bits each. No order, no prefix."""

    def length(k: int, n: np.ndarray) -> np.ndarray:
        p = prefix_length(n, percent)
        return p if k == 0 else np.where(n > 0, np.minimum(p + shared_length(p) - 1, n), 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            total, d1, d2 = (np.zeros(n, t) for t in (np.int64, np.uint64, np.uint64))
            found: list[list[np.ndarray]] = [[] for _ in range(orders)]
            for of, h in shingle_sets(W.large(batch.column(1)), size):
                total += np.bincount(of, minlength=n)
                np.add.at(d1, of, W.mixed(h ^ _SEEDS[3]))
                np.add.at(d2, of, W.mixed(h + _SEEDS[2]))
                at = _bounds(of, n)
                place = np.arange(len(h)) - at[of]
                for k in range(orders):
                    by = np.lexsort((order_key(h, k, known, counts), of))
                    found[k].append(h[by][place < length(k, np.diff(at))[of]])
            ends = [np.concatenate([[0], np.cumsum(length(k, total))]) for k in range(orders)]
            columns = [_lists(ends[k], _signed(np.concatenate(f)) if k == 0 else pa.array(
                (np.concatenate(f) >> np.uint64(48)).astype(np.uint16).view(np.int16)))
                for k, f in enumerate(found)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total), _signed(d1), _signed(d2), *columns],
                ["id", "n", "d1", "d2", *[f"p{k}" for k in range(orders)]])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(
        run, f"id {kind}, n long, d1 long, d2 long" + "".join(
            f", p{k} array<{'smallint' if k else 'long'}>" for k in range(orders)))


def block_links(ids: list, sets: list[np.ndarray], percent: int) -> list[tuple]:
    """Links of similar sets: so many that they connect what all similar pairs connect."""
    size = np.array([len(s) for s in sets])
    label = np.arange(len(sets))
    value, vocabulary = np.unique(np.concatenate(sets), return_inverse=True)
    by = np.argsort(vocabulary, kind="stable")
    owner = np.repeat(label, size)[by]
    at = np.concatenate([[0], np.cumsum(np.bincount(vocabulary, minlength=len(value)))])
    first = np.concatenate([[0], np.cumsum(size)])
    links = []
    for i in range(len(sets) - 1):
        mine = vocabulary[first[i]:first[i + 1]]
        near = np.concatenate([owner[at[v]:at[v + 1]] for v in mine])
        common = np.bincount(near, minlength=len(sets))
        hit = 100 * common >= percent * (size + size[i] - common)
        while (other := np.flatnonzero(hit & (label != label[i]))).size:
            j = int(other[0])
            links.append((ids[i], ids[j]))
            label[label == label[j]] = label[i]
    return links


def _halves(rows: DataFrame, id_: str, size: str) -> DataFrame:
    return rows.select("token", F.col("id").alias(id_), F.col("n").alias(size))


def _verified(docs: DataFrame, members: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) among the members (id, n, component) of each candidate component."""
    so_far = Window.partitionBy("component").orderBy("n", "id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    members = staged(members.withColumn("block", F.floor(
        (F.sum("n").over(so_far) - 1) / F.lit(BLOCK_SHINGLES)).cast("long")), "members")
    blocks = members.groupBy("component", "block").agg(
        F.min("n").alias("low"), F.max("n").alias("high"))
    one = blocks.select("component", F.col("block").alias("i"), "high")
    two = blocks.select("component", F.col("block").alias("j"), "low")
    # only blocks whose sizes can be that similar meet
    sides = one.join(two, "component").where(
        (F.col("i") <= F.col("j")) & (F.col("high") * 100 >= F.col("low") * percent)).select(
        "component", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    cells = hinted(staged(members.join(sides, ["component", "block"]).select(
        "id", "component", "i", "j"), "cells"))

    def compare(group: pa.Table) -> pa.Table:
        texts, sets = W.large(group["text"]), []
        for of, h in shingle_sets(texts, size):
            last = int(of[-1]) + 1
            at = _bounds(of, last)
            sets += [h[a:b] for a, b in zip(at[len(sets):-1], at[len(sets) + 1:], strict=True)]
        found = block_links(group["id"].to_pylist(), sets, percent)
        kind_ = group.schema.field("id").type
        return pa.table({"a": pa.array([x for x, _ in found], kind_),
                         "b": pa.array([y for _, y in found], kind_)})

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").join(cells, "id").groupBy("component", "i", "j").applyInArrow(
        compare, f"a {kind}, b {kind}")


def similar_classes(
    docs: DataFrame, key: str, text: str, size: int, percent: int, orders: int = 3,
) -> tuple[DataFrame, DataFrame]:
    """(members, links): members has id, n (set size) and class for each row of docs, where class
    is the smallest id of an equal set and null without shingles or id; links (a, b) between
    classes connect exactly what the similarity connects.

    Null and empty texts and texts without words have an empty set. Repeated rows are members of
    one class. Rows of the same id are one node. `orders` is 1 to 4.
    """
    spark = docs.sparkSession
    prepare(spark)
    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    nothing = np.zeros(0, np.uint32)
    described = staged(_prefixes(source, size, percent, 0, nothing, nothing), "shingles")
    # twice the prefix, as frequent shingles make room for others
    first = _prefixes(source, size, max(2 * percent - 100, 0), 1, nothing, nothing)
    frequent = first.select(F.explode("p0").alias("token")).select(
        F.shiftright("token", 32).cast("int").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD).orderBy(
        F.desc("n"), "token").limit(KNOWN_SHINGLES).toPandas()
    known = frequent["token"].to_numpy(np.int32).view(np.uint32)
    by = np.argsort(known)
    known, counts = known[by], frequent["n"].to_numpy(np.int64)[by].clip(max=(1 << 31) - 1).astype(np.int32)

    digest = ["d1", "d2", "n"]
    prefixes = _prefixes(source, size, percent, orders, known, counts)
    names = [f"p{k}" for k in range(orders)]
    classes = staged(
        prefixes.where((F.col("n") > 0) & F.col("id").isNotNull()).groupBy(*digest).agg(
            F.min("id").alias("class"), *[F.first(p).alias(p) for p in names]), "classes")
    members = staged(described.select("id", *digest).join(
        classes.select(*digest, "class"), digest, "left").select(
        "id", "n", F.when(F.col("id").isNotNull(), F.col("class")).alias("class")), "rows")
    discard(described)

    posted = classes.select(F.explode("p0").alias("token"), F.col("class").alias("id"), "n")
    shared = staged(posted.groupBy("token").agg(F.count(F.lit(1)).alias("many")).where(
        "many > 1"), "shared")
    posted = staged(posted.join(shared, "token"), "postings")
    discard(shared)
    few = posted.where(F.col("many") <= CROWD)
    pairs = staged(_halves(few, "a", "na").join(_halves(few, "b", "nb"), "token").where(
        (F.col("a") < F.col("b")) & (F.col("na") * percent <= F.col("nb") * 100)
        & (F.col("nb") * percent <= F.col("na") * 100)).select(
        "a", "b", F.least("na", "nb").alias("n")).distinct(), "pairs")
    # half of what similar sets share leaves room for shingles with equal 16 bits; so many shingles
    # have more than half of their number, or of 2^15, of different ones
    n = F.col("n")
    least = F.greatest(F.lit(1), F.least(F.lit(1 << 14), F.floor(shared_length(
        n - F.floor((n * percent + 99) / 100) + 1) / 2)))
    # one order after the other, as a prefix travels with every pair of its set
    for k in range(1, orders):
        sides = [classes.select(F.col("class").alias(id_), F.col(f"p{k}").alias(name))
                 for id_, name in (("a", "x"), ("b", "y"))]
        last, pairs = pairs, staged(pairs.join(sides[0], "a").join(sides[1], "b").where(
            F.size(F.array_intersect("x", "y")) >= least).select("a", "b", "n"), "pairs")
        discard(last)
    pairs = pairs.select("a", "b")
    # in the order of sizes, whatever lies between two similar sets is of a similar size too
    by_size = Window.partitionBy("token").orderBy("n", "id")
    chains = posted.where(F.col("many") > CROWD).select(
        F.lag("id").over(by_size).alias("a"), F.lag("n").over(by_size).alias("na"),
        F.col("id").alias("b"), F.col("n").alias("nb")).where(
        F.col("na") * 100 >= F.col("nb") * percent).select("a", "b").distinct()
    found = staged(components(pairs.unionByName(chains)), "candidates")
    discard(posted)
    wanted = found.join(classes.select(F.col("class").alias("id"), "n"), "id")
    compared = _verified(source, wanted, size, percent)
    discard(classes)
    return members, staged(compared, "links")


def similarity_groups(
    docs: DataFrame, key: str, text: str, size: int = 5, percent: int = 80, orders: int = 3,
) -> DataFrame:
    """id, n_shingles and component_id (smallest reachable id; the id itself without links) for
    each row of docs. See similar_classes for nulls, empty texts and repeated rows; a null id has
    a null component."""
    members, links = similar_classes(docs, key, text, size, percent, orders)
    found = components(links).withColumnsRenamed({"id": "class"})
    return members.join(found, "class", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"),
        F.coalesce("component", "class", "id").alias("component_id"))


def op6_multi_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_groups(table(spark, sf_dir, "documents"), "doc_id", "text", 3, 90)


OP6_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 1),
         lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end as s
  from words),
shingles as (select doc_id, unnest(s) as g from sets),
often as (select g from shingles group by g having count(*) > 1),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from shingles a join shingles b using (g) join often using (g)
  where a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from common join sets x on x.doc_id = a join sets y on y.doc_id = b
  where 100 * n >= 90 * (len(x.s) + len(y.s) - n)),
reach as (
  select doc_id, doc_id as r from sets
  union
  select reach.doc_id, links.b from reach join links on links.a = reach.r)
select sets.doc_id, len(s) as n_shingles, low as component_id
from sets join (select doc_id, min(r) as low from reach group by 1) using (doc_id)
"""
