"""Shards of equal row counts in which documents of equal text lie together.

Balanced label propagation: a document's label is its shard, its links are the documents of the
same text. In every round each linked document would move to the shard most of its neighbours
are in; as many move as that shard's quota allows, the largest groups first. Full shards make room
at the end: documents without links leave first, which cuts nothing, then the smallest groups.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linewatch.llm.common import numbered, staged, table

SHARDS = 16
#: Groups of more rows in one shard than this are spread over tasks row by row while ranked.
LARGE_GROUP = 4096
_GROUP = ["_g1", "_g2"]


def _of(values: list[int], shard: str) -> Column:
    """values[shard] as a column."""
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col(shard) + 1)


def _per_shard(df: DataFrame, shard: str, shards: int) -> list[int]:
    out = [0] * shards
    for row in df.groupBy(shard).count().collect():  # one row for each shard
        out[row[0]] = row[1]
    return out


def _propagated(linked: DataFrame, caps: list[int], shards: int) -> DataFrame:
    """linked (_rid, group, _shard) after all rounds. A round that moves nothing ends them; each
    other round settles its groups or fills a shard, so 2 * shards rounds are enough."""
    open_ = [True] * shards
    now = linked
    for _ in range(2 * shards):
        votes = now.groupBy(*_GROUP, "_shard").agg(F.count(F.lit(1)).alias("_votes"))
        wanted = votes.where(_of(open_, "_shard") == 1).groupBy(*_GROUP).agg(
            F.max(F.struct("_votes", F.xxhash64(*_GROUP, "_shard").alias("_tie"), "_shard"))
            .alias("_best"))
        seen = now.join(wanted, _GROUP, "left").select(
            "_rid", *_GROUP, "_shard",
            F.when(_of(open_, "_shard") == 1, F.col("_best._shard")).alias("_to"),
            F.col("_best._votes").alias("_votes"))
        seen = staged(seen, "moves")
        movers = seen.where(F.col("_to") != F.col("_shard"))
        wish = _per_shard(movers, "_to", shards)
        if not any(wish):
            return now
        stay = _per_shard(seen.where(
            F.col("_to").isNull() | (F.col("_to") == F.col("_shard"))), "_shard", shards)
        quota = [max(0, c - s) for c, s in zip(caps, stay, strict=True)]
        level = F.lit(63) - F.least(F.lit(63), F.floor(F.log2("_votes") * 2))
        part = F.pmod(F.when(F.col("_votes") > LARGE_GROUP, F.xxhash64("_rid")).otherwise(
            F.xxhash64(*_GROUP)), F.lit(64))
        ranked = numbered(movers, ["_to"], [F.col(g) for g in _GROUP] + [F.col("_rid")], "_rank",
                          level * 64 + part, 64 * 64)
        accepted = ranked.where(F.col("_rank") < _of(quota, "_to")).select(
            F.col("_rid").alias("_moved"), F.col("_to").alias("_new"))
        now = staged(seen.join(accepted, F.col("_rid") == F.col("_moved"), "left").select(
            "_rid", *_GROUP, F.coalesce("_new", "_shard").alias("_shard")), "labels")
        open_ = [o and w < q for o, w, q in zip(open_, wish, quota, strict=True)]
        open_ = [int(o) for o in open_]
    return now


def label_shards(docs: DataFrame, key: str, text: str, shards: int = SHARDS) -> DataFrame:
    """key, size, text_crc32, shard and slot for every row.

    Row counts of shards differ by one at most. Rows of equal text share a shard unless the text
    has more rows than the room there is, or equal counts need a group cut where no unlinked rows
    are left to move. A null text has no links and the checksum of no bytes; an empty one is a
    text. Repeated rows and repeated or null keys are rows of their own.

    Texts are read once, for their length and digests; all rounds work on a few numbers a row.
    Groups of any size are counted before the shuffle and ranked over many tasks.
    """
    body = F.col(text)
    base = docs.select(
        F.col(key).alias("_key"), (F.coalesce(F.octet_length(body), F.lit(0)) + 1)
        .cast("long").alias("size"),
        F.coalesce(F.crc32(body.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.when(body.isNotNull(), F.xxhash64(body)).alias("_g1"),
        F.when(body.isNotNull(), F.xxhash64(F.lit("text"), body)).alias("_g2"))
    base = staged(base, "texts")
    base = numbered(base, [], [F.col(c) for c in base.columns], "_rid",
                    F.xxhash64("_key", "_g1"), 1024)
    base = staged(base.withColumn("_shard", F.pmod("_rid", F.lit(shards)).cast("int")), "rows")
    sizes = _per_shard(base, "_shard", shards)
    total = sum(sizes)
    caps = [total // shards + (s < total % shards) for s in range(shards)]

    groups = base.where(F.col("_g1").isNotNull()).groupBy(*_GROUP).count().where("count > 1")
    linked = staged(base.join(groups, _GROUP, "left_semi").select("_rid", *_GROUP, "_shard"), "links")
    linked = _propagated(linked, caps, shards).select(
        F.col("_rid").alias("_linked"), F.col("_shard").alias("_label"))
    now = staged(base.join(linked, F.col("_rid") == F.col("_linked"), "left").withColumn(
        "_shard", F.coalesce("_label", "_shard")), "labelled")

    # rows move from full shards into room that is left: unlinked ones, and where these do not
    # suffice, linked ones by the size of their group in the shard; a group stays in one piece
    # where the room allows
    sizes = _per_shard(now, "_shard", shards)
    surplus = [max(0, n - c) for n, c in zip(sizes, caps, strict=True)]
    room = list(accumulate(max(0, c - n) for n, c in zip(sizes, caps, strict=True)))
    before = [0, *accumulate(surplus)][:-1]
    free = _per_shard(now.where(F.col("_linked").isNull()), "_shard", shards)
    scarce = [int(n > f) for n, f in zip(surplus, free, strict=True)]
    leaving = now.where(F.col("_linked").isNull()).select(
        "_rid", "_shard", *[F.lit(None).cast("long").alias(g) for g in _GROUP],
        F.pmod(F.xxhash64("_rid"), F.lit(256)).alias("_spread"))
    if any(scarce):
        # buckets follow the size, so that small groups leave first and no large one is one task
        held = now.where(F.col("_linked").isNotNull() & (_of(scarce, "_shard") == 1))
        votes = held.groupBy(*_GROUP, "_shard").agg(F.count(F.lit(1)).alias("_votes"))
        level = F.least(F.lit(63), F.floor(F.log2("_votes") * 2))
        part = F.when(F.col("_votes") > LARGE_GROUP, F.floor(F.col("_rid") * 64 / F.lit(total))
                      ).otherwise(F.pmod(F.xxhash64(*_GROUP), F.lit(64)))
        leaving = leaving.unionByName(held.join(votes, [*_GROUP, "_shard"]).select(
            "_rid", "_shard", *_GROUP, (256 + level * 64 + part).alias("_spread")))
    leaving = numbered(leaving, ["_shard"], [*[F.col(g) for g in _GROUP], F.col("_rid")], "_rank",
                       F.col("_spread"), 256 + 64 * 64)
    place = _of(before, "_shard") + F.col("_rank")
    into = F.lit(shards - 1)
    for s in reversed(range(shards - 1)):
        into = F.when(place < room[s], F.lit(s)).otherwise(into)
    evicted = leaving.where(F.col("_rank") < _of(surplus, "_shard")).select(
        F.col("_rid").alias("_out"), into.cast("int").alias("_into"))
    placed = now.join(evicted, F.col("_rid") == F.col("_out"), "left").select(
        F.col("_key").alias(key), "size", "text_crc32", "_rid",
        F.coalesce("_into", "_shard").alias("shard"))
    return numbered(placed, ["shard"], [F.col("_rid")], "slot", F.xxhash64("_rid"), 256).drop("_rid")


def op2_label_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_shards(table(spark, sf_dir, "documents"), "doc_id", "text").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
