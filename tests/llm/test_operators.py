"""Every operator against brute force on small inputs, with nulls, ties, repeats and empty tables."""

from __future__ import annotations

import os
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linewatch.llm import (
    common, cutting_stock, label_shards, line_frequency, multi_order_join, piece_viterbi,
    range_coder, repetition, span_language, sparse_suffixes, tokens, vantage_trees, words as W,
)

WORD = re.compile("[^\x20\x09-\x0d]+")


def texts_of(rng, n, words=80):
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        if i % 3 == 2 and out:
            w = rng.choice(out).split(" ")
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.randint(3, words))]
        out.append(" ".join(w))
    return out


def test_words_are_cut_at_ascii_white_space():
    texts = ["a b  c", "", None, "é\tà x\n", "zz", "a b", " "]
    w = W.cut(W.large(pa.array(texts)))
    raw = w.data.tobytes()
    found = [[raw[s:e].decode() for s, e in zip(w.start[a:b], w.end[a:b])]
             for a, b in zip(w.word_at[:-1], w.word_at[1:])]
    assert found == [WORD.findall(t or "") for t in texts]


# 1 --------------------------------------------------------------------------------------------

def test_repetition_equals_brute_force():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += ["x y z\nx y z\n\nx y z", "", "p " * 300, "a#b $c <d>"]
    got = repetition.profile(W.large(pa.array(texts)), 4)
    for i, t in enumerate(texts):
        w = WORD.findall(t)

        def windows(k):
            c = Counter(tuple(w[j:j + k]) for j in range(len(w) - k + 1))
            return {j + d for j in range(len(w) - k + 1) if c[tuple(w[j:j + k])] > 1 for d in range(k)}

        longest = max((k for k in range(4, len(w)) if windows(k)), default=0)
        assert got["n_repeat_words"][i] == len(windows(3))
        assert got["covered_words"][i] == len(windows(4))
        assert got["longest_repeat"][i] == longest
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert got["n_dup_lines"][i] == len(lines) - len(set(lines))
        assert (got["n_words"][i], got["word_chars"][i]) == (len(w), sum(map(len, w)))
        assert got["n_symbols"][i] == len(re.findall(r"[#*$%&|<>]", t))


def test_repetition_of_edge_cases(documents, edges):
    got = repetition.repetition(documents(*edges), "doc_id", "text").collect()
    assert len(got) == len(edges) and not any(r.kept for r in got)
    assert repetition.repetition(documents("a").limit(0), "doc_id", "text").count() == 0


# 2 --------------------------------------------------------------------------------------------

def test_shards_are_even_and_keep_copies_together(documents, edges):
    rng = random.Random(2)
    texts = [*edges, *[f"copy {rng.randrange(12)}" for _ in range(60)], *["hot"] * 90,
             *[f"single {i}" for i in range(100)]]
    rows = label_shards.label_shards(documents(*texts), "doc_id", "text", 8).collect()
    sizes = Counter(r.shard for r in rows)
    assert len(rows) == len(texts) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))
    where = {}
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
    cut = [t for t in where if t not in (None, "hot") and len(where[t]) > 1]
    assert len(cut) <= 2 and len(where["hot"]) <= 6  # 90 rows need at least 3 shards of 33
    assert label_shards.label_shards(documents("a").limit(0), "doc_id", "text").count() == 0


@pytest.mark.parametrize("groups, single", [
    ((1000, 750), 1250), ((1000, 500, 500), 1000), ((700, 600, 500, 400, 300), 0),
    ((2,) * 300 + (3,) * 100, 0), ((1500, *(2,) * 300), 0)])
def test_shards_are_even_where_unlinked_rows_do_not_suffice(documents, groups, single):
    texts = [f"group {i}" for i, n in enumerate(groups) for _ in range(n)] + [
        f"single {i}" for i in range(single)]
    random.Random(3).shuffle(texts)
    rows = label_shards.label_shards(documents(*texts), "doc_id", "text", 16).collect()
    sizes = Counter(r.shard for r in rows)
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    assert len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))
    where = {}
    for r in rows:
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
    if max(groups) <= 3:  # most small groups stay whole
        assert sum(len(w) > 1 for w in where.values()) <= len(groups) / 4


# 3 --------------------------------------------------------------------------------------------

def test_vantage_trees_with_factor_one_are_exact(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 6)).astype(np.float32)
    x[200:260] = x[5]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [
        (900, None), (901, [0.0] * 6), (902, [None] * 6), (903, [float("nan")] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = vantage_trees.nearest(df, df.where("vec_id % 20 = 0"), "vec_id", "embedding", 20, 1.0,
                                shard=70, block=8).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r.vec_id)
    for q in range(0, 300, 20):
        s = np.zeros(300)
        for k in range(6):
            s += x[q, k].astype(float) * x[:, k].astype(float)
        s[q] = -np.inf
        assert by[q] == np.lexsort((np.arange(300), -s))[:20].tolist()
    assert vantage_trees.nearest(df.limit(0), df, "vec_id", "embedding").count() == 0


def test_repeated_rows_of_a_query_are_one_query(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 5))
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows + [rows[20], rows[20]], "vec_id long, embedding array<double>")
    got = vantage_trees.nearest(df, df.where("vec_id = 20"), "vec_id", "embedding", 20, 1.0).collect()
    s = x @ x[20]
    s[20] = -np.inf
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == np.argsort(-s)[:20].tolist()


# 4 --------------------------------------------------------------------------------------------

PIECES = ["<unk>", "▁", "a", "b", "ab", "▁a", "▁ab", "ba", "bab", "abab"]


def pieces():
    byte = {v: len(PIECES) + v for v in range(256)}
    text = PIECES + [f"<0x{v:02X}>" for v in range(256)]
    score = [0.0, -2.0, -3.0, -3.5, -4.0, -3.2, -5.0, -4.5, -5.5, -6.0] + [0.0] * 256
    return piece_viterbi.Pieces(text, score, [i in range(1, 10) for i in range(len(text))], byte)


def test_pieces_have_the_best_score_and_come_back():
    p = pieces()
    encoder, decoder = piece_viterbi.Encoder(p), piece_viterbi.Decoder(p)
    rng = random.Random(4)
    texts = ["", " ", "▁", "é a", "  ab\nba"] + [
        "".join(rng.choice("ab ") for _ in range(rng.randint(1, 30))) for _ in range(80)]
    ids, at = encoder.encode(texts)
    value = {t: s for t, s, o in zip(p.text, p.score, p.ordinary) if o}
    for t, i, j in zip(texts, at[:-1], at[1:]):
        own = ids[i:j].tolist()
        assert decoder.decode(own) == t
        if set(t) <= set("ab ") and t:
            s = "▁" + t.replace(" ", "▁")
            best = [0.0] + [-1e9] * len(s)
            for k in range(1, len(s) + 1):
                best[k] = max(best[b] + value[s[b:k]] for b in range(k) if s[b:k] in value)
            assert sum(p.score[x] for x in own) == pytest.approx(best[-1])


def test_pieces_of_edge_cases(documents, edges):
    p = pieces()
    ids = piece_viterbi.encoded(documents(*edges), "doc_id", "text", p)
    got = {r.doc_id: r.text for r in piece_viterbi.decoded(ids, "doc_id", "ids", p).collect()}
    assert got == {i: t or "" for i, t in enumerate(edges)}


# 5 --------------------------------------------------------------------------------------------

def test_range_coder_takes_room_as_it_writes():
    rng = np.random.default_rng(5)
    few = [rng.integers(0, 300, 4096).astype(np.uint32) for _ in range(63)]
    blocks = [*few, rng.integers(0, 1 << 16, 4096).astype(np.uint32)]  # the last one takes most room
    tracemalloc.start()
    payloads = range_coder.compress(blocks)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(payloads[-1]) > 4096 * 2 and peak < 10e6
    for block, back in zip(blocks, range_coder.decompress(payloads, [4096] * 64), strict=True):
        assert (block == back).all()


def test_range_coder_codes_a_block_in_few_words_and_little_time():
    """Zipf-like ids with runs that come again: at most 3 microseconds an id for both ways, five
    before, and less room than counting every id by itself takes."""
    rng = np.random.default_rng(7)
    blocks = []
    for _ in range(512):
        block = rng.zipf(1.4, 4096).clip(max=50_256).astype(np.uint32)
        block[3000:4000] = block[:1000]
        blocks.append(block)
    range_coder.decompress(range_coder.compress(blocks[:8]), [4096] * 8)
    began = time.process_time()
    payloads = range_coder.compress(blocks)
    back = range_coder.decompress(payloads, [4096] * len(blocks))
    took = time.process_time() - began
    assert all((x == y).all() for x, y in zip(blocks, back, strict=True))
    assert took < 3e-6 * 512 * 4096
    n = np.unique(blocks[0], return_counts=True)[1]
    assert len(payloads[0]) < 0.95 * (-(n * np.log2(n / 4096)).sum() / 8 + 3 * len(n))


def test_range_coder_adapts_and_mixes_id_by_id():
    """Before, frequencies were counted over the block and led it; nothing was adapted or mixed."""
    k = np.arange(3000, dtype=np.uint64)
    ids = ((k * k * np.uint64(2654435761) >> np.uint64(7)) % np.uint64(300)).astype(np.uint32)
    ids[1500:2500] = ids[300:1300]
    ids[2500:] *= 200
    payloads = range_coder.compress([ids, ids[:40], ids[:1200]])
    # what an id takes depends on those before it only: a shorter block is the begin of a longer one
    assert payloads[0].startswith(payloads[1][:-6]) and payloads[0].startswith(payloads[2][:-6])
    # as the coder wrote them that had a mixing of both orders and 16-way choices
    assert ([len(p) for p in payloads], zlib.crc32(b"".join(payloads))) == ([3622, 60, 1390], 180971492)
    rng = np.random.default_rng(3)
    drift = np.concatenate([rng.integers(0, 16, 2000), rng.integers(1000, 1016, 2000)]).astype(np.uint32)
    payload = range_coder.compress([drift])[0]
    assert len(payload) < 4000 * 5 / 8  # counted over the block, 32 ids take five bits
    assert (range_coder.decompress([payload], [4000])[0] == drift).all()


def test_words_of_bytes_are_cut_and_told_apart():
    data, separator = range_coder.byte_vocabulary()
    texts = ["", "  a\n\nb  ", "\n", "é fast.  x", " ", "don't \n stop", "a b", "\n\n ñandú!!! 12ab"]
    words, count = tokens._chunks(pa.array(texts, pa.large_string()))
    assert words.to_pylist() == ["  a", "\n\nb", "  ", "\n", "é", " fast.", "  x", " ", "don't",
                                 " \n stop", "a", " b", "\n\n ñandú!!!", " 12ab"]
    assert count.tolist() == [0, 3, 1, 3, 1, 2, 2, 2]
    e = tokens.Encoder(data, "byte", separator)
    ids, at = e.encode(texts, 2)
    for i, t in enumerate(texts):
        assert ids[at[i]: at[i + 1]].tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids + [2]


def test_range_coder_round_trip():
    rng = np.random.default_rng(5)
    blocks = [rng.zipf(1.3, 700) % 50257, np.zeros(100, int), rng.integers(0, 65536, 333),
              np.array([], int), np.full(50, 65535)]
    payloads = range_coder.compress(blocks)
    back = range_coder.decompress(payloads, [len(b) for b in blocks])
    assert all((x == y).all() for x, y in zip(blocks, back))
    assert len(payloads[1]) < 60
    a, b = b"hello", b"world" * 40
    assert range_coder.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_id_files_hold_the_library_s_ids(spark, documents, edges, tmp_path):
    data, separator = range_coder.byte_vocabulary()
    texts = [*edges[:7], "a  b\n\n c ", "x\ty", "stop<|endoftext|>q", "é e\u0301", "w " * 9000]
    docs = documents(*[(100 - i, t) for i, t in enumerate(texts)])
    path = str(tmp_path / "ids")
    range_coder.write_ids(docs, "doc_id", "text", data, separator, path, block=512)
    got = range_coder.digests(range_coder.read_ids(spark, path, "doc_id"), "doc_id").collect()
    tokenizer, start = tokens._tokenizer(data), 0
    for r in sorted(got, key=lambda r: r.doc_id):
        ids = tokenizer.encode(texts[100 - r.doc_id] or "", add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc)
        start += len(ids)
    assert len(got) == len(texts)
    broken = spark.read.parquet(path).withColumn("crc32", F.lit(1).cast("long"))
    broken.write.parquet(str(tmp_path / "broken"))
    with pytest.raises(Exception, match="checksum"):
        range_coder.read_ids(spark, str(tmp_path / "broken"), "doc_id").collect()


# 6 --------------------------------------------------------------------------------------------

def linked(texts, size, percent):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").lower())
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size
                    else {tuple(w)} if w else set())
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return [(i, len(s), c) for i, (s, c) in enumerate(zip(sets, label))]


@pytest.mark.parametrize("crowd,block", [(24, 500_000), (2, 300)])
def test_similar_groups_equal_brute_force(documents, edges, monkeypatch, crowd, block):
    monkeypatch.setattr(multi_order_join, "CROWD", crowd)
    monkeypatch.setattr(multi_order_join, "BLOCK_SHINGLES", block)
    texts = [*edges, *texts_of(random.Random(6), 90)]
    base = texts[20].split(" ")
    texts += [" ".join(base[:k] + ["edit"] + base[k + 1:]) for k in range(0, len(base), 3)]
    got = multi_order_join.similarity_groups(documents(*texts), "doc_id", "text", 3, 80).collect()
    assert sorted(map(tuple, got)) == linked(texts, 3, 80)


def test_similar_groups_of_nothing_and_null_ids(documents):
    empty = multi_order_join.similarity_groups(documents("a").limit(0), "doc_id", "text")
    assert empty.count() == 0
    got = multi_order_join.similarity_groups(
        documents((None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f")), "doc_id", "text")
    assert sorted(map(str, got.collect())) == sorted(
        [str(r) for r in got.collect() if r.doc_id == 3] +
        ["Row(doc_id=None, n_shingles=2, component_id=None)"])


def test_prefixes_travel_one_order_at_a_time_and_what_was_read_goes(documents, monkeypatch):
    """Before, each pair carried the prefixes of all orders, four bytes a shingle, and shuffle
    files and scratch of all steps stayed."""
    written = []

    def noted(df, label):
        out = staged(df, label)
        written.append((label, out))
        return out

    def kept(df):
        return os.path.exists(df._scratch.removeprefix("file:"))

    staged = common.staged
    monkeypatch.setattr(multi_order_join, "staged", noted)
    texts = texts_of(random.Random(6), 60)
    base = texts[20].split(" ")
    texts += [" ".join(base[:k] + ["edit"] + base[k + 1:]) for k in range(0, len(base), 3)]
    got = multi_order_join.similarity_groups(documents(*texts), "doc_id", "text", 3, 80)
    kinds = {f.name: f.dataType.simpleString() for f in dict(written)["classes"].schema}
    assert kinds["p1"] == kinds["p2"] == "array<smallint>"
    pairs = [df for label, df in written if label == "pairs"]
    assert len(pairs) == 3 and all(df.columns == ["a", "b", "n"] for df in pairs)
    assert {label for label, df in written if not kept(df)} >= {"classes", "postings", "shared", "shingles"}
    assert [kept(df) for df in pairs] == [False, False, True]
    assert sorted(map(tuple, got.collect())) == linked(texts, 3, 80)


# 7 --------------------------------------------------------------------------------------------

def passages(texts, size):
    words = [WORD.findall(t or "") for t in texts]
    where = {}
    for d, w in enumerate(words):
        for i in range(len(w) - size + 1):
            where.setdefault(tuple(w[i:i + size]), set()).add(d)
    out = []
    for d, w in enumerate(words):
        for first in (True, False):
            hits = [i for i in range(len(w) - size + 1)
                    if len(s := where[tuple(w[i:i + size])]) > 1 and (min(s) == d) == first]
            spans = []
            for i in hits:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + size
                else:
                    spans.append([i, i + size])
            out += [(d, a, b - a, first) for a, b in spans]
    return sorted(out)


def test_passages_equal_brute_force(documents, edges):
    rng = random.Random(7)
    texts = [*edges, *texts_of(rng, 60, 60)]
    shared = texts[12]
    texts += [" ".join([t, shared, "end"]) for t in texts_of(rng, 5, 20)] + [shared, shared]
    got = sparse_suffixes.repeated_passages(documents(*texts), "doc_id", "text", 12, 4).collect()
    assert sorted(map(tuple, got)) == passages(texts, 12)


def test_cut_passages_leave_the_rest(documents):
    shared = " ".join(f"s{i}" for i in range(60))
    docs = documents(f"a {shared} b", f"c\n{shared}\nd", shared, None, "")
    spans = sparse_suffixes.repeated_passages(docs, "doc_id", "text").where("not first")
    left = {r.doc_id: r.text for r in sparse_suffixes.without_spans(
        docs, "doc_id", "text", spans).collect()}
    assert left == {0: f"a {shared} b", 1: "c\nd", 3: None, 4: ""}


# 8 --------------------------------------------------------------------------------------------

def test_languages_of_mixed_text(documents, edges):
    rng = random.Random(8)
    en = ["the thing then other with this", "that which they there where"]
    fr = ["le garçon été français être", "où leçon élève même château"]
    train = documents(*[" ".join(rng.choices(" ".join(en).split(), k=30)) for _ in range(20)]
                      ).unionByName(documents(
                          *[" ".join(rng.choices(" ".join(fr).split(), k=30)) for _ in range(20)],
                          lang="fr"))
    model = span_language.learn(train, "doc_id", "text", "lang")
    mixed = "the other thing with this where " * 4 + "le garçon français même élève " * 3
    texts = [*edges, mixed, "привет мир"]
    got = span_language.predicted(documents(*texts), "text", model).orderBy("doc_id").collect()
    for r, t in zip(got, texts):
        assert (r.lang_pred == "und") == (not re.search(r"[^\W\d_]", t or ""))
        assert 0 <= r.score <= 1
    assert [s.lang for s in got[len(edges)].spans] == ["en", "fr"]
    assert got[len(edges)].spans[1].start_word == 24
    nothing = span_language.learn(train.limit(0), "doc_id", "text", "lang")
    assert {r.lang_pred for r in span_language.predicted(
        documents("word"), "text", nothing).collect()} == {"und"}


def test_languages_in_scripts_outside_the_table_are_learned(spark, documents):
    words = {
        "am": "ሰላም ልጅ ቤት ውሃ መንገድ ትምህርት", "en": "the other thing with this where",
        "ff": "𞤀𞤣𞤤𞤢𞤥 𞤨𞤵𞤤𞤢𞤪 𞤶𞤢𞤲𞤺𞤮 𞤬𞤵𞤤𞤬𞤵𞤤𞤣𞤫", "gu": "ગુજરાતી ભાષા પાણી ઘર છોકરો શાળા"}
    train = spark.createDataFrame(
        [(f"{x}{i}", x, " ".join(random.Random(i).choices(w.split(), k=30)))
         for x, w in words.items() for i in range(5)], "doc_id string, lang string, text string")
    model = span_language.learn(train, "doc_id", "text", "lang")
    texts = [*words.values(), f"{words['en']} {words['gu']}", "n\u00ba \u00ba \u2019 the \U0001F600 2024"]
    got = span_language.predicted(documents(*texts), "text", model).orderBy("doc_id").collect()
    assert [(r.lang_pred, r.score) for r in got[:4]] == [(x, 1.0) for x in words]
    assert [s.lang for s in got[4].spans] == ["en", "gu"] and got[5].lang_pred == "en"
    english = span_language.learn(train.where("lang = 'en'"), "doc_id", "text", "lang")
    got = span_language.predicted(documents(*texts), "text", english).orderBy("doc_id").collect()
    assert [r.score for r in got[:5]] == [0.0, 1.0, 0.0, 0.0, 1.0]


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(8)
    sizes = [0, 1, 7, 3, 7]
    scores, at = rng.normal(size=(sum(sizes), 3)).astype(np.float32), np.cumsum([0, *sizes])
    label = span_language.viterbi(scores, at, 0.7)

    def worth(path, s):
        return sum(s[i, p] for i, p in enumerate(path)) - 0.7 * sum(a != b for a, b in zip(path, path[1:]))

    import itertools
    for a, b in zip(at[:-1], at[1:]):
        if b > a:
            best = max(worth(p, scores[a:b]) for p in itertools.product(range(3), repeat=b - a))
            assert worth(label[a:b].tolist(), scores[a:b]) == pytest.approx(best, abs=1e-4)


# 9 --------------------------------------------------------------------------------------------

def test_labels_beyond_a_hundred_and_twenty_eight_languages():
    scores = np.full((6, 200), -9.0, np.float32)
    scores[:3, 199], scores[3:, 130] = 9.0, 9.0
    at = np.array([0, 3, 6])
    assert span_language.viterbi(scores, at).tolist() == [199] * 3 + [130] * 3


def test_sampled_rows_are_those_of_the_smallest_hashes(spark):
    """A language of many rows is drawn by hash, and the model is that of the drawn rows alone."""
    df = spark.createDataFrame([(i, "abc " * (i % 7 + 1), "aa") for i in range(3000)] + [
        (9000 + i, "xyz", "bb") for i in range(5)], "doc_id long, text string, lang string")
    model = span_language.learn(df, "doc_id", "text", "lang", sample=50)
    low = df.where("lang = 'aa'").orderBy(span_language.draw("doc_id"), "doc_id").limit(50)
    again = span_language.learn(low.unionByName(df.where("lang = 'bb'")), "doc_id", "text", "lang")
    assert model.languages == again.languages == ["aa", "bb"]
    assert np.array_equal(model.scores, again.scores) and np.array_equal(model.allowed, again.allowed)


def test_patterns_place_every_rest_near_the_optimum():
    rng = random.Random(9)
    demand = {c: rng.randint(1, 200) for c in range(1, 65)}
    found = cutting_stock.patterns(demand, 64)
    placed = Counter()
    for kind, n in found:
        assert sum(c * a for c, a in kind) <= 64
        for c, a in kind:
            placed[c] += a * n
    assert placed == demand
    sizes = np.array(sorted(demand))
    _, amounts = cutting_stock.column_generation(
        sizes, np.array([demand[c] for c in sizes], float), 64)
    assert sum(n for _, n in found) <= amounts.sum() * 1.02 + 2


def test_packing_holds_every_id_once(documents, edges):
    data, separator = cutting_stock.word_vocabulary()
    texts = [*edges, "some Words here", "w " * 9000]
    rows = cutting_stock.packed(documents(*texts), "doc_id", "text", data, separator).collect()
    tokenizer = tokens._tokenizer(data)
    for d, t in enumerate(texts):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for r in sorted((r for r in rows if r.doc_id == d), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at: at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for s in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    assert cutting_stock.packed(documents("a").limit(0), "doc_id", "text", data, separator).count() == 0


# 10 -------------------------------------------------------------------------------------------

def test_boilerplate_of_a_site_goes(spark):
    rows = [(i, "a", f"top\n\nown {i}\n top ") for i in range(10)] + [
        (20 + i, "b", "top\nx") for i in range(3)] + [(30, None, None), (31, "a", ""), (None, "a", "top")]
    pages = spark.createDataFrame(rows, "id long, host string, text string")
    got = {r.id: r for r in line_frequency.drop_boilerplate(
        pages, "id", F.col("host"), F.split("text", "\n", -1)).collect()}
    assert got[3].kept_lines == ["", "own 3"] and got[3].n_dropped == 2
    assert got[20].kept_lines == ["top", "x"] and got[None].kept_lines == []
    assert got[30].kept_lines is None and got[31].kept_lines == [""] and len(got) == len(rows)


def test_site_lines_equal_the_sql_where_lines_are_dropped(spark, tmp_path):
    rows = [(i, f"https://H{i % 3}.org/{i}", f"<p>top {i % 3}</p><p> top {i % 3}</p><b>own {i}</b>"
             + "<i>foot</i>" * (i % 4 == 0)) for i in range(40)] + [
        (100 + i, f"http://small{i}.org/x", "<p>kept</p>") for i in range(4)] + [
        (200 + i, "http://two.org/x", f"<p>shared</p><p>own {i}</p>") for i in range(2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(map(tuple, line_frequency.op10_site_lines(spark, str(tmp_path)).collect()))
    duck = duckdb.connect()
    duck.sql(f"create view pages as from '{tmp_path}/pages.parquet/*.parquet'")
    assert got == sorted(duck.sql(line_frequency.OP10_SQL).fetchall())
    assert all(r[3] == 2 for r in got[:40]) and all(r[3] == 0 for r in got[40:44])
    assert [r[3] for r in got[44:]] == [1, 1]  # a host of two pages has boilerplate too


# shared ---------------------------------------------------------------------------------------

def test_components_and_numbers(spark):
    rng = random.Random(11)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(5, 5), (None, 3)]
    got = dict(map(tuple, common.components(
        spark.createDataFrame(edges, "a long, b long")).collect()))
    label = {i: i for e in edges if None not in e and e[0] != e[1] for i in e}
    for _ in range(80):
        for a, b in edges:
            if a in label and b in label and None not in (a, b):
                label[a] = label[b] = min(label[a], label[b])
    assert got == label
    rows = common.numbered(spark.range(100).withColumn("k", F.col("id") % 3), ["k"], [F.col("id")],
                           "n", F.xxhash64("id"), 7).collect()
    assert all(sorted(r.n for r in rows if r.k == k) == list(range(n)) for k, n in ((0, 34), (1, 33), (2, 33)))


def test_encoder_of_a_worker_is_kept_and_starts_anew_after_an_error():
    data, separator = cutting_stock.word_vocabulary()
    encoder = tokens.encoder(data, "word", separator)
    assert tokens.encoder(bytes(bytearray(data)), "word", separator) is encoder
    texts = ["a  b\nc", "tab\tand\u00a0more", "<|endoftext|> x", "", "\u200bzero \U0001f600 ok", "a c"]
    plain = [encoder.tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    for _ in range(2):
        ids, at = encoder.encode(texts, 2)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == plain
    with pytest.raises(TypeError):
        encoder.encode(["new words", 7], 2)
    assert not encoder.number and len(encoder.ids) == 0
    ids, at = encoder.encode(texts, 2)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == plain


def test_words_of_equal_parts_are_encoded_once(monkeypatch):
    data, separator = cutting_stock.word_vocabulary()
    encoder, sent = tokens.Encoder(data, "word", separator), []
    encoded = encoder._encoded
    monkeypatch.setattr(encoder, "_encoded", lambda words, between: sent.extend(words) or encoded(
        words, between))
    texts = ["Été, été. (ÉTÉ) don't I'LL ***", "été; a1b2 -- ...été!? ß÷x \"É\"", "", " \n", "'s 's, _a_ Σας"]
    for _ in range(2):
        ids, at = encoder.encode(texts, 2)
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [
            encoder.tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert sent.count("été") == 1 and not any("É" in w for w in sent) and len(sent) == len(set(sent))


def test_frequent_shingles_are_known_by_half_their_bits(spark):
    h = np.array([3 << 32 | 5, 7 << 32 | 9, 1 << 63 | 1, 11], np.uint64)
    known, counts = np.array([7, 1 << 31], np.uint32), np.array([40, 90])
    for order in range(3):
        key = multi_order_join.order_key(h, order, known, counts)
        assert np.argsort(key)[2:].tolist() == [1, 2] and len(set(key.tolist())) == 4
