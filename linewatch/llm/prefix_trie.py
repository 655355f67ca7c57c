"""A prefix trie of conversations, held as balanced parentheses, a shard at a time.

A turn is a digest of its role and text, a node the digest of all turns from the first to its own.
A conversation is the row of its nodes, and rows in the order of their bytes are the trie in
preorder. Shards are ranges of that order. Inside a shard the trie is a sequence of parentheses:
findclose, over blocks that know their least excess, gives where a subtree ends; the rank of the
pairs "()" counts its leaves; differences of cumulative sums give its conversations and savings.
Only nodes on the path of a shard's first or last conversation can lie in other shards too: these
spines are merged by their digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linewatch.llm import words as W
from linewatch.llm.common import hinted, prepare, staged, table

#: Turns of one shard, about; a conversation is never cut.
SHARD_TURNS = 200_000
#: Parentheses of a block.
BLOCK = 64
#: Ids that are joined to one row before the rows of a node are hashed in turn.
CHUNK_IDS = 4_096
#: Conversations that share a beginning: so many ids in a row start like the first of them.
FAMILY = 20
#: A conversation takes fewer turns than this from the first of its family.
HEADS = 4
NO_ENDS = hashlib.sha256(b"").hexdigest()


class Parentheses:
    """A balanced sequence; open is true where a node opens."""

    def __init__(self, open_: np.ndarray, block: int = BLOCK):
        self.open, self.block = open_, block
        self.excess = np.cumsum(np.where(open_, 1, -1)).astype(np.int64)
        n = len(open_)
        size = -(-n // block) * block
        self.rows = np.full(size, np.iinfo(np.int64).max)
        self.rows[:n] = self.excess
        self.rows = self.rows.reshape(-1, block)
        self.least = [self.rows.min(1)]  # of blocks, of pairs of them, of fours ...
        while len(self.least[-1]) > 1:
            m = self.least[-1]
            if len(m) % 2:
                m = np.append(m, np.iinfo(np.int64).max)
            self.least.append(m.reshape(-1, 2).min(1))
        pair = np.zeros(n + 1, np.int64)
        pair[1:n] = open_[:-1] & ~open_[1:]
        self.pairs = np.cumsum(pair)  # pairs "()" that begin before a position

    def _within(self, block: np.ndarray, after: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The first place in each block after `after` with an excess of target or less, or -1."""
        out = np.full(len(block), -1)
        place = np.arange(self.block)
        for i in range(0, len(block), 4096):
            s = slice(i, i + 4096)
            hit = (self.rows[block[s]] <= target[s, None]) & (place > after[s, None])
            out[s] = np.where(hit.any(1), hit.argmax(1), -1)
        return out

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """Where the parentheses opened at `at` close."""
        target = self.excess[at] - 1
        block = at // self.block
        found = self._within(block, at % self.block, target)
        far = np.flatnonzero(found < 0)
        out = np.where(found >= 0, block * self.block + found, -1)
        if len(far):
            node, level, want = block[far] + 1, np.zeros(len(far), np.int64), target[far]
            up = np.ones(len(far), bool)  # up and to the right to a node that goes low enough
            while up.any():
                for k, least in enumerate(self.least):
                    own = np.flatnonzero(up & (level == k))
                    if len(own):
                        low = least[node[own]] <= want[own]
                        up[own[low]] = False
                        on = own[~low]
                        node[on] += 1
                        even = on[node[on] % 2 == 0]
                        node[even] //= 2
                        level[even] += 1
            for k in range(len(self.least) - 1, 0, -1):  # and down to its first block
                own = np.flatnonzero(level == k)
                if len(own):
                    left = self.least[k - 1][2 * node[own]] <= want[own]
                    node[own] = 2 * node[own] + ~left
                    level[own] -= 1
            out[far] = node * self.block + self._within(node, np.full(len(far), -1), want)
        return out

    def leaves(self, at: np.ndarray, close: np.ndarray) -> np.ndarray:
        return self.pairs[close] - self.pairs[at]


def _least_of(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The least of values[start:end] for each non-empty range."""
    rows, out = values, np.empty(len(start), values.dtype)
    size, level = end - start, 0
    want = np.floor(np.log2(np.maximum(size, 1))).astype(np.int64)
    while True:
        own = np.flatnonzero(want == level)
        out[own] = np.minimum(rows[start[own]], rows[end[own] - (1 << level)])
        level += 1
        if not (want >= level).any():
            return out
        rows = np.minimum(rows[: len(rows) - (1 << level - 1)], rows[1 << level - 1:])


def encode(path: np.ndarray, at: np.ndarray, words: np.ndarray, ending: np.ndarray,
           conv: np.ndarray) -> dict[str, np.ndarray]:
    """The trie of a shard. path: the two halves of each node's digest, (turns, 2), of
    conversations in order, which start at `at`; words: words of each turn; ending, conv: how many
    conversations end with each of these, and the smallest of them. A row for each node, in
    preorder, root first; `edge` is true for nodes that other shards may have too."""
    n_convs, size = len(at) - 1, np.diff(at)
    of = np.repeat(np.arange(n_convs), size)
    depth = np.arange(len(of)) - at[:-1][of] + 1
    # as a node is the digest of its whole path, equal nodes at a depth have equal paths
    before = at[:-1][np.maximum(of - 1, 0)] + depth - 1
    known = (of > 0) & (depth <= size[np.maximum(of - 1, 0)])
    known[known] = (path[before[known]] == path[known]).all(1)
    shared = np.bincount(of[known], minlength=n_convs)
    new = np.flatnonzero(~known)
    nodes = len(new) + 1
    level = np.concatenate([[0], depth[new]])
    own_words = np.concatenate([[0], words[new]])
    entry = np.concatenate([[0], of[new]])
    # closed before each conversation's nodes open, the root outside
    closing = np.append(size[:-1] - shared[1:], size[-1]) if n_convs else np.zeros(0, np.int64)
    opening = size - shared
    bits = np.ones(2 * nodes, bool)
    runs = np.stack([opening, closing], 1).ravel()
    bits[1:-1] = np.repeat(np.tile([True, False], n_convs), runs)
    bits[-1] = False
    p = Parentheses(bits)
    opened = np.flatnonzero(bits)
    close = p.findclose(opened)
    subtree = (close - opened + 1) // 2
    first = np.arange(nodes)
    # the node a conversation ends in: its last new one, or the last node of its path so far
    key = np.sort(level * np.int64(nodes) + first)
    last_new = np.cumsum(opening)  # preorder number of the last new node of each conversation
    end_at = key[np.searchsorted(key, size * np.int64(nodes) + last_new, "right") - 1] % nodes
    parent = np.full(nodes, -1)
    parent[1:] = key[np.searchsorted(key, (level[1:] - 1) * np.int64(nodes) + first[1:], "right") - 1] % nodes
    weight = np.bincount(end_at, ending, nodes).astype(np.int64) if n_convs else np.zeros(nodes, np.int64)
    members = np.concatenate([[0], np.cumsum(weight)])
    members = members[first + subtree] - members[first]
    spared = np.concatenate([[0], np.cumsum((members - 1) * own_words)])
    # each conversation but a turnless one brings nodes and ends at the last of them, so those below
    # a node are neighbours
    start, upto = np.where(level == 0, 0, entry), entry[first + subtree - 1] + 1
    edge = np.zeros(nodes, bool)
    for c in (0, n_convs - 1) if n_convs else ():
        node = end_at[c]
        while node >= 0:
            edge[node] = True
            node = parent[node]
    edge[0] = True
    end_of = np.full(nodes, -1)
    end_of[end_at] = np.arange(n_convs)
    return {
        "node": np.concatenate([np.zeros((1, 2), np.uint64), path[new]]), "parent": parent,
        "depth": level, "words": own_words, "n_convs": members,
        "conv_id": _least_of(conv, start, upto) if n_convs else np.zeros(nodes, np.int64),
        "n_children": np.bincount(parent[1:], minlength=nodes),
        "n_leaves": p.leaves(opened, close), "saved_tokens": spared[first + subtree] - spared[first],
        "edge": edge, "end_of": end_of,
    }


def _binary(halves: np.ndarray) -> pa.Array:
    """(rows, 2) halves of digests as 16 bytes each."""
    data = np.ascontiguousarray(halves.astype(">u8")).tobytes()
    offsets = np.arange(0, len(data) + 1, 16, dtype=np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(halves), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _paths(rebuilt: DataFrame) -> DataFrame:
    """(conv_id, n_turns, path, end, words) of conversations (conv_id, turns: t1, t2, n_words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            turns = batch.column(1)
            at = np.concatenate([[0], np.cumsum(np.asarray(turns.value_lengths(), np.int64))])
            flat = turns.flatten()
            t = [np.asarray(flat.field(k), np.int64).view(np.uint64) for k in (0, 1)]
            depth = (np.arange(len(t[0])) - np.repeat(at[:-1], np.diff(at)) + 1).astype(np.uint64)
            salt = depth * np.uint64(0x9E3779B97F4A7C15)
            path = np.empty((len(depth), 2), np.uint64)
            for k, h in enumerate((W.mixed(t[0] ^ W.mixed(salt)), W.mixed(t[1] + W.mixed(~salt)))):
                run_ = np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(h)]) if len(h) \
                    else np.zeros(1, np.uint64)
                path[:, k] = run_[1:] ^ np.repeat(run_[at[:-1]], np.diff(at))
            data = np.ascontiguousarray(path.astype(">u8")).tobytes()
            paths = pa.Array.from_buffers(pa.large_binary(), n, [
                None, pa.py_buffer((at * 16).astype(np.int64)), pa.py_buffer(data)])
            last = np.zeros((n, 2), np.uint64)
            some = np.diff(at) > 0
            last[some] = path[at[1:][some] - 1]
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), flat.field(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(at)), paths.cast(pa.binary()), _binary(last),
                 lists], ["conv_id", "n_turns", "path", "end", "words"])

    return rebuilt.mapInArrow(
        run, "conv_id long, n_turns long, path binary, end binary, words array<long>")


def _ends(paths: DataFrame, tasks: int) -> DataFrame:
    """(end, n_turns, conv_id, ending, sha): for each different conversation the smallest and the
    number of those equal to it, and the hash of all their ids. Ids are laid out by range, so one
    conversation with very many copies is many tasks; what meets in one place is a row for some
    thousands of its ids."""

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(2), np.int64)
            ends = np.array(batch.column(0).to_pylist(), object)
            if not len(ids):
                continue
            edge = np.flatnonzero(np.append(True, ends[1:] != ends[:-1]))
            cuts = np.unique(np.concatenate([edge, np.arange(0, len(ids), CHUNK_IDS)]))
            to = np.append(cuts[1:], len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(cuts)), batch.column(1).take(pa.array(cuts)),
                 pa.array(ids[cuts]), pa.array(to - cuts),
                 pa.array([",".join(map(str, ids[a:b].tolist()))
                           for a, b in zip(cuts, to, strict=True)])],
                ["end", "n_turns", "conv_id", "ending", "ids"])

    chunks = paths.select("end", "n_turns", "conv_id").repartitionByRange(
        tasks, "end", "conv_id").sortWithinPartitions("end", "conv_id").mapInArrow(
        join_ids, "end binary, n_turns long, conv_id long, ending long, ids string")

    def hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, total, state = None, None, 0, None

        def row():
            return pa.RecordBatch.from_pydict(
                {"end": pa.array([now[0]], pa.binary()), "n_turns": [now[1]], "conv_id": [first],
                 "ending": [total], "sha": [state.hexdigest()]})

        out = []
        for batch in batches:
            for end, turns, conv, n, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (end, turns) != now:
                    if now is not None:
                        out.append(row())
                    now, first, total, state = (end, turns), conv, 0, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
                total += n
                if len(out) >= 1000:
                    yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
                    out = []
        if now is not None:
            out.append(row())
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]

    return chunks.repartition(tasks, "end").sortWithinPartitions("end", "conv_id").mapInArrow(
        hash_ids, "end binary, n_turns long, conv_id long, ending long, sha string")


_NODE = ("shard int, node binary, parent binary, depth long, words long, conv_id long, "
         "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string, edge boolean")


def _shard_nodes(entries: DataFrame, shards: int) -> DataFrame:
    """All nodes of the trie of each shard of entries (path, words, ending, sha, conv_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, words, columns = [], [], []
        for batch in batches:
            data += batch.column(0).to_pylist()
            words.append(np.asarray(batch.column(1).flatten(), np.int64))
            columns.append([batch.column(k) for k in range(2, 6)])
        if not data:
            return
        at = np.concatenate([[0], np.cumsum([len(x) // 16 for x in data])])
        path = np.frombuffer(b"".join(data), ">u8").reshape(-1, 2).astype(np.uint64)
        ending, conv, shard = (np.concatenate([np.asarray(c[k], np.int64) for c in columns])
                               for k in (0, 2, 3))
        sha = np.array([x for c in columns for x in c[1].to_pylist()] + [NO_ENDS], object)
        t = encode(path, at, np.concatenate(words), ending, conv)
        for i in range(0, len(t["depth"]), 50_000):
            s = slice(i, i + 50_000)
            up = t["parent"][s]
            root = up < 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(up), shard[0], np.int32)), _binary(t["node"][s]),
                 pc.if_else(pa.array(root), None, _binary(t["node"][up])),
                 pa.array(t["depth"][s]), pa.array(t["words"][s]), pa.array(t["conv_id"][s]),
                 pa.array(t["conv_id"][up], mask=root),
                 *[pa.array(t[k][s]) for k in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
                 pa.array(sha[t["end_of"][s]], pa.string()), pa.array(t["edge"][s])],
                [f.split()[0] for f in _NODE.split(", ")])

    return entries.repartitionByRange(shards, "path").sortWithinPartitions("path").select(
        "path", "words", "ending", "sha", "conv_id", F.spark_partition_id().alias("shard")
    ).mapInArrow(run, _NODE)


def merged(pieces: pd.DataFrame) -> pd.DataFrame:
    """Spine nodes out of their pieces in several shards, deepest first."""
    pieces = pieces.assign(node=pieces["node"].map(bytes), parent=pieces["parent"].map(
        lambda x: None if x is None else bytes(x)))
    # what a piece has outside the pieces of other spine nodes below it
    below = pieces.groupby(["shard", "parent"])[["n_leaves", "saved_tokens"]].sum()
    count = pieces.groupby(["shard", "parent"]).size()
    at = pd.MultiIndex.from_arrays([pieces["shard"], pieces["node"]])
    spine_children = count.reindex(at).fillna(0).to_numpy(np.int64)
    inner = below.reindex(at).fillna(0)
    own = (pieces["n_convs"] - 1) * pieces["words"]
    pieces = pieces.assign(
        n_leaves=np.where(pieces["n_children"] == 0, 0,
                          pieces["n_leaves"].to_numpy() - inner["n_leaves"].to_numpy(np.int64)),
        saved_tokens=pieces["saved_tokens"].to_numpy() - own.to_numpy()
        - inner["saved_tokens"].to_numpy(np.int64),
        n_children=pieces["n_children"].to_numpy() - spine_children,
        ends_sha256=pieces["ends_sha256"].where(pieces["ends_sha256"] != NO_ENDS))
    out = pieces.groupby("node").agg(
        parent=("parent", "first"), depth=("depth", "first"), words=("words", "first"),
        conv_id=("conv_id", "min"), n_convs=("n_convs", "sum"), n_children=("n_children", "sum"),
        n_leaves=("n_leaves", "sum"), saved_tokens=("saved_tokens", "sum"),
        ends_sha256=("ends_sha256", "first"))
    out["ends_sha256"] = out["ends_sha256"].fillna(NO_ENDS)
    out["saved_tokens"] += (out["n_convs"] - 1) * out["words"]
    rows = {k: dict(v) for k, v in zip(out.index, out.to_dict("records"), strict=True)}
    for key in sorted(rows, key=lambda k: -rows[k]["depth"]):
        r = rows[key]
        if not r["n_children"]:
            r["n_leaves"] = 1
        r["parent"] = r["parent"] if isinstance(r["parent"], bytes) else None
        if r["parent"] is not None:
            up = rows[r["parent"]]
            up["n_children"] += 1
            up["n_leaves"] += r["n_leaves"]
            up["saved_tokens"] += r["saved_tokens"]
    for r in rows.values():
        r["parent_conv_id"] = None if r["parent"] is None else rows[r["parent"]]["conv_id"]
    result = pd.DataFrame([{"node": k, **r} for k, r in rows.items()])
    result["parent_conv_id"] = result["parent_conv_id"].astype("Int64")
    return result[["node", *_RESULT]]


_RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


def prefix_nodes(rebuilt: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of the trie of conversations (conv_id unique, turns: array of t1, t2, n_words)."""
    prepare(rebuilt.sparkSession)
    paths = staged(_paths(rebuilt), "paths")
    total = paths.agg(F.sum("n_turns"), F.count(F.lit(1))).first()
    if not total[1]:
        return rebuilt.sparkSession.createDataFrame([], ", ".join(
            f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in _RESULT))
    shards = max(1, -(-(total[0] + total[1]) // shard_turns))
    ends = staged(_ends(paths, shards), "ends")
    entries = paths.select("conv_id", "path", "words").join(
        ends.select("conv_id", "ending", "sha"), "conv_id")
    nodes = staged(_shard_nodes(entries, shards), "shard-nodes")
    # a node of one shard has all its subtree there; one of several is merged
    edges = nodes.where("edge")
    several = staged(edges.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "node"), "spine-keys")
    spine_keys = hinted(several)
    # as many rows as shards times shared turns of neighbours: the rest never meets in one place
    spines = staged(edges.join(spine_keys, "node", "left_semi").groupBy(F.lit("all")).applyInPandas(
        merged, "node binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
                "n_children long, n_leaves long, saved_tokens long, ends_sha256 string"), "spines")
    up = hinted(spines.select(F.col("node").alias("parent"), F.col("conv_id").alias("_up")))
    inner = nodes.join(spine_keys, "node", "left_anti").join(up, "parent", "left").withColumn(
        "parent_conv_id", F.coalesce("_up", "parent_conv_id"))
    return inner.select(*_RESULT).unionByName(spines.select(*_RESULT))


def _head_turns(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("int")


def rebuilt_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation with its first turns, 0 to 3 of them by its id, taken
    from the first of its family of ids. Rows without conv_id are no conversation."""
    conv = F.col("conv_id").cast("long")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # digests and word counts move, texts do not
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        conv.alias("conv_id"), F.struct(
            F.col("turn").alias("turn"), F.xxhash64(role, text).alias("t1"),
            F.xxhash64(F.lit("turn"), role, text).alias("t2"),
            F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_words")).alias("x"))
    whole = staged(rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("turns")),
                   "conversations")
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = whole.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("heads"))
    h = _head_turns(F.col("conv_id"))
    taken = F.slice(F.coalesce("heads", F.slice("turns", 1, 0)), F.lit(1), h)
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return whole.withColumn("base", base).join(heads, "base", "left").select(
        "conv_id", F.transform(F.concat(taken, rest), lambda x: F.struct(
            x["t1"], x["t2"], x["n_words"])).alias("turns"))


def conversation_trie(turns: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations (conv_id, turn, role, text): conv_id
    (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and
    ends_sha256 (of the ids of the members that end there).

    Turns are in order of `turn`, null first; rows of equal turn follow by a hash of role and text,
    and each of them is a turn. Null role or text is empty and equal to empty ones. A row without
    conv_id is left out. A conversation of which no turn is left is a member of the root alone. An
    empty table has no node. Other columns are not looked at, whatever their names. A very long
    text is hashed in the scan; a conversation is one row of 24 bytes a turn. Copies of one
    conversation are one entry of the trie, and its ids are hashed a row of thousands at a time."""
    return prefix_nodes(rebuilt_conversations(turns), shard_turns)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


OP11_SQL = r"""
with recursive turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, role, text) as i
  from conversations where conv_id is not null),
heads as (
  select conv_id, list_reduce(
      list_prepend(4294967295::bigint, list_transform(
        range(1, length(conv_id::varchar) + 1), lambda k: ascii(substr(conv_id::varchar, k::int, 1))::bigint)),
      lambda c, b: list_reduce(
        [xor(c, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) as crc
  from (select distinct conv_id from turns)),
convs as (select conv_id, conv_id - conv_id % 20 as base, xor(crc, 4294967295) % 4 as h from heads),
taken as (
  select c.conv_id, t.i, t.role, t.text from convs c join turns t on t.conv_id = c.base where t.i <= c.h
  union all
  select c.conv_id, t.i, t.role, t.text from convs c join turns t using (conv_id) where t.i > c.h),
rebuilt as (
  select *, row_number() over (partition by conv_id order by i) as depth from taken),
walk as (
  select conv_id, 0::bigint as depth, '' as node, null::varchar as parent, '' as text from convs
  union all
  select w.conv_id, r.depth, sha256(w.node || chr(1) || r.role || chr(2) || r.text), w.node, r.text
  from walk w join rebuilt r on r.conv_id = w.conv_id and r.depth = w.depth + 1),
lengths as (select conv_id, max(depth) as d from walk group by conv_id),
nodes as (
  select depth, node, any_value(parent) as parent, min(conv_id) as conv_id, count(*) as n_convs,
         len(regexp_extract_all(any_value(text), '[^\x20\x09-\x0D]+')) as words,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id)
           filter (where l.d = depth), '')) as ends
  from walk join lengths l using (conv_id) group by depth, node),
children as (select parent, count(*) as n from nodes where parent is not null group by parent),
under as (
  select distinct a.depth, a.node, b.depth as low, b.node as below
  from walk a join walk b on a.conv_id = b.conv_id and b.depth >= a.depth),
sums as (
  select u.depth, u.node, sum((coalesce(c.n, 0) = 0)::int) as n_leaves,
         sum((n.n_convs - 1) * n.words) as saved
  from under u join nodes n on n.depth = u.low and n.node = u.below left join children c on c.parent = u.below
  group by u.depth, u.node)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n, 0) as n_children,
       s.n_leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, n.ends as ends_sha256
from nodes n join sums s on s.depth = n.depth and s.node = n.node
left join children c on c.parent = n.node
left join nodes p on p.node = n.parent and p.depth = n.depth - 1
"""
