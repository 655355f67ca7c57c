"""The conversation trie and the fingerprint trie against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from linewatch.llm import prefix_trie, simhash_trie, words as W
from tests.conftest import SMALL

WORD = re.compile("[^\x20\x09-\x0d]+")

# 11 -------------------------------------------------------------------------------------------


def trie_of(rows):
    """Rows (conv_id, turn, role, text) to all columns of the contract, by sets of members."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    saved, leaves = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        words = len(WORD.findall(node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in below)
        leaves[node] = sum(leaves[k] for k in below) or 1
    out = []
    for node, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(node))))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m),
                    len(children.get(node, [])), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


TURNS = "conv_id long, turn long, role string, text string, node string, path string"


def trie_rows(df, **more):
    found = prefix_trie.conversation_trie(df, **more).select(*prefix_trie._RESULT).collect()
    return sorted((tuple(r) for r in found), key=str)


@pytest.mark.parametrize("shard_turns", [25, 10_000])
def test_conversation_trie_equals_brute_force(spark, shard_turns):
    rng = random.Random(11)
    rows = []
    for c in [*range(70), *range(-45, -20), 1 << 40]:
        for turn in range(rng.choice([0, 1, 1, 2, 3, 5])):
            rows.append((c, turn, rng.choice(["user", "bot"]), rng.choice(["a b", "c", "d e f", ""])))
    rows += [(200 + i, t, "user", "hot copy") for i in range(60) for t in range(6)]
    rows += [(300, None, "user", "first"), (300, None, "user", "x"), (300, 2, None, None),
             (301, 1, "user", "same turn"), (302, 0, "", " \n\t"), (None, 1, "user", "nobody's")]
    rows += [(303, t, "user", f"long {t}") for t in range(300)]
    if shard_turns > 25:  # ties have an order of their own; one of two equal rows is no tie
        rows += [(301, 1, "user", "same turn")]
    else:
        rows = [r for r in rows if r[:2] != (300, None)]
    df = spark.createDataFrame([(*r, "x", None) for r in rows], TURNS)
    if shard_turns > 25:
        rows = [r for r in rows if r[0] != 300]
        df = df.where("conv_id is null or conv_id <> 300")
    got = trie_rows(df, shard_turns=shard_turns)
    assert got == trie_of(rows)
    assert any(r[1] == 0 and r[3] > 100 for r in got)


def test_conversation_trie_of_ties_and_nothing(spark):
    rows = [(20, None, "user", "a"), (20, None, "user", "b"), (20, 5, "user", "c"),
            (40, 1, None, "x " * 50_000)]
    found = trie_rows(spark.createDataFrame([(*r, None, None) for r in rows], TURNS))
    again = trie_rows(spark.createDataFrame([(*r, None, None) for r in reversed(rows)], TURNS))
    assert found == again and len(found) > 2
    empty = spark.createDataFrame([], TURNS)
    assert trie_rows(empty) == []
    assert trie_rows(spark.createDataFrame([(None, 1, "a", "b", None, None)], TURNS)) == []


def test_turnless_conversations_are_members_of_the_root(spark):
    c = next(i for i in range(1, 20) if zlib.crc32(str(i).encode()) % 4 == 3)
    rows = [(c, 0, "user", "gone"), (c + 20, 0, "user", "a b c"), (c + 20, 1, "user", "d")]
    df = spark.createDataFrame([(*r, None, None) for r in rows], TURNS)
    got = trie_rows(df)
    assert got == trie_of(rows)
    assert any(r[1] == 0 and r[-1] != prefix_trie.NO_ENDS for r in got)


def test_parentheses():
    rng = random.Random(5)
    for n in (1, 2, 40, 700):
        bits, depth, left = [True], 1, n - 1
        while depth:
            if left and (rng.random() < 0.55 or depth == 1):
                bits.append(True)
                depth, left = depth + 1, left - 1
            else:
                bits.append(False)
                depth -= 1
        open_ = np.array(bits)
        stack, close = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                close[stack.pop()] = i
        at = np.flatnonzero(open_)
        for block in (4, 64):
            p = prefix_trie.Parentheses(open_, block)
            found = p.findclose(at)
            assert found.tolist() == [close[i] for i in at.tolist()]
            assert p.leaves(at, found).tolist() == [
                sum(bits[k] and not bits[k + 1] for k in range(i, close[i])) for i in at.tolist()]


def test_conversation_query_equals_its_sql(spark):
    db = duckdb.connect()
    db.execute(f"create view conversations as select * from '{SMALL}/conversations.parquet'")
    want = db.execute(f"select {', '.join(prefix_trie._RESULT)} from ({prefix_trie.OP11_SQL})").fetchall()
    got = prefix_trie.op11_prefix_trie(spark, SMALL).select(*prefix_trie._RESULT).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    rows = db.execute("select conv_id, turn, role, text from conversations").fetchall()
    assert sorted((tuple(r) for r in got), key=str) == trie_of(rows)


# 13 -------------------------------------------------------------------------------------------


def fingerprint(text, size=3):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[k:k + size]) for k in range(len(w) - size + 1)] or [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def smallest_reachable(ids, prints, budget=2):
    label = {i: i for i in ids}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= budget:
                x, y = sorted((root(ids[a]), root(ids[b])))
                label[y] = x
    return [root(i) for i in ids]


def noisy(rng, n):
    base = [rng.getrandbits(64) for _ in range(n)]
    out = list(base)
    for x in base:
        for _ in range(6):
            out.append(x ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))))
    return out + [0, 1, (1 << 64) - 1, 1 << 63, 3 << 62]


def test_fingerprints_equal_brute_force(edges):
    rng = random.Random(13)
    texts = [*edges, "A B", "a b c", "É é x y", *[" ".join(rng.choice("abcdef") for _ in range(
        rng.randint(1, 9))) for _ in range(80)]]
    got = simhash_trie.fingerprints(W.large(pa.array(texts)))
    assert got.tolist() == [fingerprint(t) for t in texts]


def test_close_pairs_equal_brute_force():
    rng = random.Random(14)
    x = np.unique(np.array(noisy(rng, 40), np.uint64))
    for a, b in ((x, None), (x[::2], x[1::2])):
        i, j = simhash_trie.close_pairs(a, b)
        other = a if b is None else b
        near = np.bitwise_count(a[:, None] ^ other[None, :]) <= 2
        want = set(zip(*np.nonzero(np.triu(near, 1) if b is None else near)))
        assert len(i) == len(want) and set(zip(i, j)) == want


@pytest.mark.parametrize("node_rows", [1, 6, 8_192])
def test_links_of_leaves_connect_what_is_close(spark, rows, node_rows):
    rng = random.Random(15)
    prints = list(dict.fromkeys(noisy(rng, 25)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    leaves = spark.createDataFrame(list(zip(signed, range(len(prints)))), "fp long, id long")
    links = simhash_trie.close_links(leaves, node_rows).collect()
    assert all((prints[r.a] ^ prints[r.b]).bit_count() <= 2 for r in links)
    ids = list(range(len(prints)))
    label = {i: i for i in ids}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for r in links:
        x, y = sorted((root(r.a), root(r.b)))
        label[y] = x
    assert [root(i) for i in ids] == smallest_reachable(ids, prints)


def test_simhash_groups_equal_brute_force(spark, documents, edges):
    rng = random.Random(16)
    words = [f"w{i}" for i in range(300)]
    texts = list(edges)
    for _ in range(30):
        base = [rng.choice(words) for _ in range(rng.randint(30, 400))]
        texts += [" ".join(base)] * rng.randint(1, 3)
        for _ in range(3):
            other = list(base)
            other[rng.randrange(len(other))] = rng.choice(words)
            texts.append(" ".join(other).upper() if rng.random() < 0.3 else " ".join(other))
    df = documents(*texts).withColumns({"fp": F.lit(1), "id": F.lit("x"), "component": F.lit(2)})
    got = {r.doc_id: r for r in simhash_trie.simhash_groups(df, "doc_id", "text").collect()}
    prints = [fingerprint(t) for t in texts]
    assert len(got) == len(texts)
    assert [got[i].fingerprint for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    want = smallest_reachable(list(range(len(texts))), prints)
    assert [got[i].component_id for i in range(len(texts))] == want
    assert len(set(want)) < len(set(prints))


def test_simhash_of_shared_and_missing_ids(spark, rows):
    df = spark.createDataFrame([(5, "a b c"), (5, "x y z"), (7, "a b c"), (8, "x y z"), (None, "x y z"),
                                (5, "a b c"), (9, "something else entirely")], "doc_id long, text string")
    found = simhash_trie.simhash_groups(df, "doc_id", "text").select("doc_id", "component_id")
    assert rows(found) == sorted([(5, 5), (5, 5), (5, 5), (7, 5), (8, 5), (9, 9), (None, None)],
                                 key=lambda r: tuple(map(str, r)))
    assert simhash_trie.simhash_groups(df.limit(0), "doc_id", "text").count() == 0


def test_simhash_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in simhash_trie.op13_simhash_trie(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    ids, prints = [r.doc_id for r in docs], [fingerprint(r.text) for r in docs]
    assert [got[i].fingerprint for i in ids] == [f"{p:016x}" for p in prints]
    assert [got[i].component_id for i in ids] == smallest_reachable(ids, prints)
