"""SimHash fingerprints and a self-join of their binary trie.

A fingerprint is a path of 64 bits in a binary trie. The join starts with the pair (root, root) and
steps down: a pair of nodes gives the pairs of their children, the bits in which they differ are
added up, and a pair with more than the allowed number is pruned with all that lies below it. The
upper levels are Spark joins of node pairs with the nodes below, four bits a step; a pair whose
nodes hold few enough fingerprints is walked to the end inside a task.

Equal fingerprints are one leaf, so a group of copies costs one row. A task returns no more links
of a pair of nodes than it takes to connect what is close, and the links become components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from linewatch.llm import words as W
from linewatch.llm.common import components, prepare, staged, table

SHINGLE = 3
SEED = 42
#: Differing bits of linked fingerprints, at most.
ERRORS = 2
#: Bits of one step of the distributed walk.
STEP = 4
#: Fingerprints below a node of a pair that a task walks to the end. Sets how the work is cut up,
#: not what it gives; a node that holds more is always opened.
NODE_ROWS = 8_192
#: Pairs of a node pair that are compared outright instead of being walked further.
_FEW = 32
_SPACED = np.frombuffer(b" ", np.uint8)[0]


def _normal(w: W.Words) -> tuple[bytes, np.ndarray]:
    """The words of a slice with one space after each, and where each of them starts."""
    size = w.end - w.start
    start = np.cumsum(size + 1) - (size + 1)
    out = np.full(int((size + 1).sum()), _SPACED, np.uint8)
    inside = np.ones(len(out), bool)
    inside[start + size] = False
    spaces = W._SPACE[w.data]
    out[inside] = w.data[~spaces]
    return out.tobytes(), start


def fingerprints(texts: pa.Array, size: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text of a column made by words.large()."""
    out, at = np.zeros(len(texts), np.uint64), 0
    digest = xxhash.xxh64_intdigest
    for i, j in W.slices(texts):
        w = W.cut(texts[i:j], lower=True)
        data, start = _normal(w)
        n = np.diff(w.word_at)
        shingles = np.where(n >= size, n - size + 1, np.minimum(n, 1))
        of = np.repeat(np.arange(j - i), shingles)
        first = w.word_at[:-1][of] + np.arange(len(of)) - np.repeat(
            np.cumsum(shingles) - shingles, shingles)
        last = np.minimum(first + size, w.word_at[1:][of])
        ends = np.append(start, len(data))[last] - 1
        h = np.fromiter((digest(data[a:b], SEED) for a, b in zip(
            start[first].tolist(), ends.tolist(), strict=True)), np.uint64, len(of))
        some = np.flatnonzero(shingles)
        if len(some):
            bits = np.zeros((len(some), 64), np.int64)
            edge = (np.cumsum(shingles) - shingles)[some]
            for k in range(64):
                one = (h >> np.uint64(63 - k)) & np.uint64(1)
                bits[:, k] = np.add.reduceat(one.astype(np.int64), edge)
            over = 2 * bits > shingles[some][:, None]
            out[at + some] = np.packbits(over, axis=1).view(">u8").ravel().astype(np.uint64)
        at += j - i
    return out


def _ones(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def close_pairs(a: np.ndarray, b: np.ndarray | None, depth: int = 0, errors: int = 0,
                budget: int = ERRORS) -> tuple[np.ndarray, np.ndarray]:
    """(positions in a, positions in b) of all pairs with at most `budget` differing bits.

    a and b are sorted, without repeats, and each has one path of `depth` bits, which differ in
    `errors` of them. Without b, all pairs within a are found once. Both tries are walked together
    a bit at a time; a node is a range of a sorted array."""
    same = b is None
    b = a if same else b
    found: list[tuple[np.ndarray, np.ndarray]] = []
    low_a, low_b = np.zeros(1, np.int64), np.zeros(1, np.int64)
    high_a, high_b = np.array([len(a)]), np.array([len(b)])
    spent = np.array([errors])
    while len(spent):
        n_a, n_b = high_a - low_a, high_b - low_b
        few = (n_a * n_b <= _FEW) | (depth == 64)
        if few.any():
            many, width = (n_a * n_b)[few], n_b[few]
            place = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            x = np.repeat(low_a[few], many) + place // np.repeat(width, many)
            y = np.repeat(low_b[few], many) + place % np.repeat(width, many)
            near = _ones(a[x] ^ b[y]) <= budget
            if same:
                near &= x < y
            found.append((x[near], y[near]))
        if few.all():
            break
        low_a, high_a, low_b, high_b, spent = (
            v[~few] for v in (low_a, high_a, low_b, high_b, spent))
        bit = np.uint64(1) << np.uint64(63 - depth)
        path = ~((bit << np.uint64(1)) - np.uint64(1)) if depth else np.uint64(0)
        mid_a = np.searchsorted(a, (a[low_a] & path) | bit)
        mid_b = np.searchsorted(b, (b[low_b] & path) | bit)
        next_ = []
        for x in (0, 1):
            for y in (0, 1):
                la, ha = (low_a, mid_a) if not x else (mid_a, high_a)
                lb, hb = (low_b, mid_b) if not y else (mid_b, high_b)
                e = spent + (x != y)
                keep = (la < ha) & (lb < hb) & (e <= budget)
                if same and x and not y:  # the mirror of (0, 1) of a node with itself
                    keep &= low_a != low_b
                next_.append([v[keep] for v in (la, ha, lb, hb, e)])
        low_a, high_a, low_b, high_b, spent = (
            np.concatenate(v) for v in zip(*next_, strict=True))
        depth += 1
    if not found:
        none = np.zeros(0, np.int64)
        return none, none
    x, y = (np.concatenate(v) for v in zip(*found, strict=True))
    return x, y


def spanning(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Which of the links (x, y) between n things suffice to connect what all of them connect."""
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    used = np.zeros(len(x), bool)
    for k, (i, j) in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
        i, j = root(i), root(j)
        if i != j:
            parent[i], used[k] = j, True
    return used


def _nodes(leaves: DataFrame, depth: int) -> DataFrame:
    """(node, n): the paths of `depth` bits and the fingerprints below each."""
    node = F.shiftrightunsigned("fp", 64 - depth) if depth else F.lit(0).cast("long")
    return leaves.groupBy(node.alias("node")).agg(F.count(F.lit(1)).alias("n"))


def node_pairs(leaves: DataFrame, node_rows: int = NODE_ROWS, budget: int = ERRORS) -> DataFrame:
    """(depth, x, y, errors): pairs of trie nodes, each with itself or a larger one, that together
    cover all pairs of leaves (fp) with at most `budget` differing bits. Both nodes hold at most
    node_rows leaves."""
    spark = leaves.sparkSession
    open_ = staged(_nodes(leaves, 0).select(
        F.col("node").alias("x"), F.col("node").alias("y"), F.lit(0).alias("errors"),
        F.col("n").alias("nx"), F.col("n").alias("ny")), "node-pairs")
    done = None
    for depth in range(0, 64 + STEP, STEP):
        small = F.greatest("nx", "ny") <= (node_rows if depth < 64 else 2)
        ready = open_.where(small).select(F.lit(depth).alias("depth"), "x", "y", "errors")
        done = ready if done is None else done.unionByName(ready)
        if open_.where(~small).isEmpty():
            break
        below = staged(_nodes(leaves, depth + STEP), "nodes").select(
            F.shiftrightunsigned("node", STEP).alias("up") if depth else F.lit(0).cast("long").alias("up"),
            "node", "n")
        sides = [below.select(F.col("up").alias(up), F.col("node").alias(node), F.col("n").alias(n))
                 for up, node, n in (("x", "cx", "nx"), ("y", "cy", "ny"))]
        spent = F.col("errors") + F.bit_count(F.col("cx").bitwiseXOR(F.col("cy")).bitwiseAND(
            (1 << STEP) - 1))
        open_ = staged(
            open_.where(~small).select("x", "y", "errors").join(sides[0], "x").join(sides[1], "y")
            .where((spent <= budget) & ((F.col("x") < F.col("y")) | (F.col("cx") <= F.col("cy"))))
            .select(F.col("cx").alias("x"), F.col("cy").alias("y"),
                    spent.cast("int").alias("errors"), "nx", "ny"), "node-pairs")
    return done if done is not None else spark.createDataFrame(
        [], "depth int, x long, y long, errors int")


def close_links(leaves: DataFrame, node_rows: int = NODE_ROWS, budget: int = ERRORS) -> DataFrame:
    """(a, b): links between ids of leaves (fp, id; fp unique) that connect exactly what pairs of
    fingerprints with at most `budget` differing bits connect."""
    pairs = staged(node_pairs(leaves, node_rows, budget), "ready-pairs")
    ends = pairs.select("depth", F.col("x").alias("node")).union(
        pairs.select("depth", F.col("y").alias("node"))).distinct()
    depths = [r[0] for r in ends.select("depth").distinct().collect()]  # 17 at most
    paths = [leaves.select(
        F.lit(d).alias("depth"),
        (F.shiftrightunsigned("fp", 64 - d) if d else F.lit(0).cast("long")).alias("node"),
        "fp", "id") for d in depths]
    if not paths:
        return leaves.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    rows = paths[0]
    for p in paths[1:]:
        rows = rows.unionByName(p)
    # a node of a ready pair holds at most node_rows leaves, so it is one bounded row
    blocks = staged(rows.join(ends, ["depth", "node"], "left_semi").groupBy("depth", "node").agg(
        F.collect_list(F.struct("fp", "id")).alias("leaves")), "node-leaves")
    left = blocks.select("depth", F.col("node").alias("x"), F.col("leaves").alias("left"))
    right = blocks.select("depth", F.col("node").alias("y"), F.col("leaves").alias("right"))
    met = pairs.join(left, ["depth", "x"]).join(right, ["depth", "y"]).select(
        "depth", "errors", (F.col("x") == F.col("y")).alias("same"), "left", "right")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = [batch.column(k)[i].as_py() for k in range(3)]
                sides = []
                for k in (3, 4):
                    values = batch.column(k)[i].values
                    fp = np.asarray(values.field(0), np.int64).view(np.uint64)
                    by = np.argsort(fp)
                    sides.append((fp[by], np.asarray(values.field(1), np.int64)[by]))
                (a, ids), (b, jds) = sides
                x, y = close_pairs(a, None if row[2] else b, row[0], row[1], budget)
                used = spanning(x, y + (0 if row[2] else len(a)), len(a) + len(b))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[x[used]]), pa.array(jds[y[used]])], ["a", "b"])

    return met.mapInArrow(walk, "a long, b long")


def fingerprinted(docs: DataFrame, key: str, text: str, size: int = SHINGLE) -> DataFrame:
    """(id, fp): the key and the fingerprint of each row of docs."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(fingerprints(W.large(batch.column(1)), size).view(
                        np.int64))], ["id", "fp"])

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        run, "id long, fp long")


def simhash_groups(
    docs: DataFrame, key: str, text: str, size: int = SHINGLE, budget: int = ERRORS,
    node_rows: int = NODE_ROWS,
) -> DataFrame:
    """key (long), fingerprint (16 hex digits) and component_id (the smallest key reachable by links
    of fingerprints that differ in at most `budget` bits; the own one without links) of every row.

    Null and empty texts and texts without a word have fingerprint zero and are linked like any
    other; a text with fewer than `size` words is one shingle. Shingles count as often as they
    occur, and a bit set in exactly half of them is 0. Repeated rows give repeated rows; rows of
    equal key are one document, so they connect what each of them is linked to. A row without a key
    takes no part: its component is null. Other columns of docs are not looked at, whatever their
    names. A text is worked on whole, in one task. An empty table gives no rows."""
    rows = staged(fingerprinted(docs, key, text, size), "fingerprints")
    known = rows.where(F.col("id").isNotNull())
    leaves = staged(known.groupBy("fp").agg(F.min("id").alias("id")), "leaves")
    # a key with several fingerprints connects their leaves
    several = known.groupBy("id").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where(
        "low <> high").select("id")
    own = leaves.select("fp", F.col("id").alias("leaf"))
    bridges = known.join(several, "id", "left_semi").distinct().join(own, "fp").select(
        F.col("id").alias("a"), F.col("leaf").alias("b"))
    found = components(close_links(leaves, node_rows, budget).unionByName(bridges))
    of = leaves.join(found, "id", "left").select(
        "fp", F.coalesce("component", "id").alias("component"))
    # a fingerprint of very many rows is one row of `of`; AQE splits its side of the join
    return rows.join(of, "fp", "left").select(
        F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component")).alias("component_id"))


def op13_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), "doc_id", "text")
