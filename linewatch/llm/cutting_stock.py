"""Packs documents into sequences by column generation for the cutting-stock problem.

A document is cut into full sequences and a rest. Rests are counted by length class. A linear
program over patterns (how many rests of each class a sequence holds) is solved by column
generation: dynamic programming for the knapsack prices new patterns. Pattern counts are rounded
down, the few rests left over are packed first-fit by descending class, and ranked rests of each
class are assigned to the places the patterns have for it.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from linewatch.llm import tokens
from linewatch.llm.common import numbered, prepare, staged, table

LENGTH = 4096
#: Tokens of a length class: a rest counts as the next multiple. 256 classes bound the program.
UNIT = 16
#: Patterns are priced until the program is proven within this of its optimum.
GAP = 0.005
MOST_PATTERNS = 20_000
END = 2


def priced(value: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: dynamic programming over the room of a sequence."""
    best, choice = np.zeros(room + 1), np.full(room + 1, -1)
    for r in range(1, room + 1):
        fits = int(np.searchsorted(sizes, r, "right"))
        best[r], choice[r] = best[r - 1], -1
        if fits:
            gain = best[r - sizes[:fits]] + value[:fits]
            k = int(gain.argmax())
            if gain[k] > best[r]:
                best[r], choice[r] = gain[k], k
    pattern, r = np.zeros(len(sizes)), room
    while r > 0:
        if choice[r] < 0:
            r -= 1
        else:
            pattern[choice[r]] += 1
            r -= int(sizes[choice[r]])
    return best[room], pattern


def column_generation(sizes: np.ndarray, demand: np.ndarray, room: int
                      ) -> tuple[np.ndarray, np.ndarray]:
    """(patterns by column, amounts) of the linear program, by the revised simplex method."""
    m = len(sizes)
    basis = np.diag((room // sizes).astype(float))
    inverse = np.diag(1.0 / (room // sizes))
    amount = inverse @ demand
    for step in range(MOST_PATTERNS):
        prices = inverse.sum(0)
        worth, pattern = priced(prices, sizes, room)
        if worth <= 1 + GAP:
            break
        direction = inverse @ pattern
        up = direction > 1e-9
        ratio = np.full(m, np.inf)
        ratio[up] = amount[up] / direction[up]
        out = int(ratio.argmin())
        theta = ratio[out]
        amount = np.maximum(amount - theta * direction, 0)
        amount[out] = theta
        basis[:, out] = pattern
        inverse[out] /= direction[out]
        others = np.delete(np.arange(m), out)
        inverse[others] -= np.outer(direction[others], inverse[out])
        if step % 200 == 199:  # against the build-up of rounding
            inverse = np.linalg.inv(basis)
            amount = np.maximum(inverse @ demand, 0)
    return basis, amount


def patterns(demand: dict[int, int], room: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """[(((class, places), ...), sequences), ...] with a place for each of demand's rests."""
    found: Counter = Counter()
    left = Counter({c: n for c, n in demand.items() if n})
    if left.get(room):
        found[((room, 1),)] += left.pop(room)
    if left:
        sizes = np.array(sorted(left))
        columns, amounts = column_generation(sizes, np.array([left[c] for c in sizes], float), room)
        for column, amount in zip(columns.T, np.floor(amounts + 1e-9).astype(int), strict=True):
            kind = tuple((int(c), int(a)) for c, a in zip(sizes, column, strict=True) if a)
            while amount and any(left[c] < a * amount for c, a in kind):
                amount -= 1
            if amount:
                found[kind] += int(amount)
                for c, a in kind:
                    left[c] -= a * int(amount)
        by_room: dict[int, list[Counter]] = {}
        for c in sorted((c for c in left if left[c]), reverse=True):
            for _ in range(left[c]):
                r = min((r for r in by_room if r >= c and by_room[r]), default=None)
                own = by_room[r].pop() if r is not None else Counter()
                own[c] += 1
                by_room.setdefault((room if r is None else r) - c, []).append(own)
        for own in (o for rest in by_room.values() for o in rest):
            found[tuple(sorted(own.items()))] += 1
    return sorted(found.items())


def pieces(docs: DataFrame, key: str, text: str, vocabulary: bytes, separator: str,
           length: int = LENGTH, end: int = END) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: the full sequences and the rest of each text."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(vocabulary, "word", separator)
        for batch in batches:
            for row, texts in tokens.batches_of(batch.column(1).to_pylist()):
                ids, at = encoder.encode(texts, end)
                raw, total = memoryview(ids.astype("<u4")).cast("B"), np.diff(at)
                count = -(-total // length)
                of = np.repeat(np.arange(len(texts)), count)
                start = (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)) * length
                size = np.minimum(length, total[of] - start)
                first = at[of] + start
                crc = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in
                       zip(first.tolist(), (first + size).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(of + row)), pa.array(start), pa.array(size),
                     pa.array(crc, pa.int64()), pa.array(total[of])],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, "
                                  "doc_tokens long")


def packed(docs: DataFrame, key: str, text: str, vocabulary: bytes, separator: str,
           length: int = LENGTH, unit: int = UNIT, end: int = END) -> DataFrame:
    """The pieces with sequence_id and offset.

    Null and empty texts are one end token. Repeated rows and null keys are documents of their
    own. Only the histogram of 256 classes comes to the driver, and only the patterns, some
    thousand rows, are sent back; pieces are ranked within their class over many tasks.
    """
    spark = docs.sparkSession
    cut = staged(pieces(docs, key, text, vocabulary, separator, length, end).withColumn(
        "_class", F.ceil(F.col("length") / unit).cast("int")), "pieces")
    demand = {r[0]: r[1] for r in cut.groupBy("_class").count().collect()}
    slots, before, sequence = [], Counter(), 0
    for kind, n in patterns(demand, length // unit):
        for c, places in kind:
            slots.append((c, before[c], before[c] + places * n, places, sequence))
            before[c] += places * n
        sequence += n
    plan = spark.createDataFrame(
        slots, "_c int, _from long, _to long, _places long, _sequence long")
    ranked = numbered(cut, ["_class"], [F.col("doc_id"), F.col("start"), F.col("ids_crc32")],
                      "_rank", F.xxhash64("doc_id", "start"))
    placed = ranked.join(F.broadcast(plan), (F.col("_class") == F.col("_c")) & (
        F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))).withColumn(
        "sequence_id", F.col("_sequence") + F.expr("(_rank - _from) div _places"))
    within = Window.partitionBy("sequence_id").orderBy(
        F.desc("_class"), "_rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        F.col("doc_id").alias(key), "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(within), F.lit(0)).cast("long").alias("offset"))


def word_vocabulary() -> tuple[bytes, str]:
    import public_tokenizers

    return tokens.vocabulary(public_tokenizers.path("word_bpe_49k.json")), "<|endoftext|>"


def op9_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), "doc_id", "text", *word_vocabulary())
