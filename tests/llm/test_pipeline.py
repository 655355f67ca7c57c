"""The pipeline, stage by stage, against brute force over its own input."""

from __future__ import annotations

import re
import time
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from linewatch.llm import cutting_stock, tokens
from linewatch.llm.common import staged, table
from tests.llm.test_operators import linked, passages

SMALL = "/root/testdata/sf0.001"


def test_each_stage_over_all_that_the_one_before_kept(spark):
    docs, seen = table(spark, SMALL, "documents"), {}
    for name, stage in pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = staged(stage(spark, docs, SMALL), name)
        seen[name] = (before, docs.collect())
        if name != "packing":
            assert docs.columns == pipeline.COLUMNS
            assert all(r.n_chars == len(r.text) for r in seen[name][1])

    before, after = seen["language_id"]
    kept = {r.doc_id for r in after}
    assert all(any(c.isalpha() for c in before[i].text) for i in kept)
    assert len(kept) > 0.9 * len(before)

    before, after = seen["line_dedup"]
    for r in after:
        assert set(r.text.split("\n")) <= set(before[r.doc_id].text.split("\n"))

    before, after = seen["near_duplicates"]
    ids = sorted(before)
    groups = linked([before[i].text for i in ids], 5, 80)
    assert {r.doc_id for r in after} == {ids[i] for i, n, c in groups if c == i or not n}

    before, after = seen["passages"]
    ids = sorted(before)
    gone = {i: set() for i in ids}
    for d, start, n, first in passages([before[i].text for i in ids], 50):
        if not first:
            gone[ids[d]] |= set(range(start, start + n))
    left = {i: [w for k, w in enumerate(before[i].text.split()) if k not in gone[i]] for i in ids}
    assert {r.doc_id: r.text.split() for r in after} == {i: w for i, w in left.items() if w}

    before, after = seen["packing"]
    tokenizer = tokens._tokenizer(cutting_stock.word_vocabulary()[0])
    for i, r in before.items():
        ids = np.array(tokenizer.encode(r.text, add_special_tokens=False).ids + [2], "<u4")
        own = sorted((p for p in after if p.doc_id == i), key=lambda p: p.start)
        assert sum(p.length for p in own) == len(ids)
        for p in own:
            assert p.ids_crc32 == zlib.crc32(ids[p.start: p.start + p.length].tobytes())


def test_line_dedup_drops_the_common_lines_of_a_source(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    before = docs.collect()
    size, held = Counter(r.source for r in before), Counter()
    for r in before:
        held.update({(r.source, x.strip(" ")) for x in (r.text or "").split("\n")} - {(r.source, "")})
    gone = {k for k, n in held.items() if n >= 5 and n > pipeline.SOURCE_RATIO * size[k[0]]}
    want = {}
    for r in before:
        lines = None if r.text is None else r.text.split("\n")
        kept = lines and [x for x in lines if (r.source, x.strip(" ")) not in gone]
        if lines == kept or re.search(r"[^\x20\x09-\x0d]", "\n".join(kept)):
            want[r.doc_id] = kept if kept is None else "\n".join(kept)
    assert len(gone) > 10 and sum(want.get(r.doc_id) != r.text for r in before) > 100
    after = pipeline.line_dedup(spark, docs, "").collect()
    assert len(after) == len(want) and {r.doc_id: r.text for r in after} == want


def test_copies_of_a_text_make_none_of_its_lines_boilerplate(documents, spark):
    texts = ["copied line\nanother of it"] * 60 + [f"top\nown line {i}" for i in range(40)]
    got = {r.doc_id: r.text for r in pipeline.line_dedup(spark, documents(*texts), "").collect()}
    assert all(got[i] == texts[i] for i in range(60))
    assert all(got[i] == f"own line {i - 60}" for i in range(60, 100))


def test_documents_that_share_an_id_stay(spark):
    words = [f"w{i}" for i in range(60)]
    one, near = " ".join(words), " ".join([*words[:59], "other"])
    rows = [(1, one), (2, near), (3, "quite another text of some seven words"), (3, one), (3, one),
            (None, one), (4, "lonely words")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r.doc_id or 0, r.text) for r in pipeline.near_duplicates(spark, docs, "").collect())
    assert got == sorted([(1, one), (3, one), (3, rows[2][1]), (0, one), (4, "lonely words")])


def test_empty_documents(spark, tmp_path):
    table(spark, SMALL, "documents").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_shuffle_files_go_with_the_write_and_passages_are_cut_after_their_windows(spark, monkeypatch):
    """Before, shuffle files waited for the driver's garbage, and windows of passages and the texts
    they are cut from were on disk together."""
    sc = spark.sparkContext
    disk = sc._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        names = disk.getAllBlocks().mkString(" ").split()
        return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}

    before = files()
    rows = staged(spark.range(5000).groupBy((F.col("id") % 7).alias("k")).count(), "x")
    assert rows.count() == 7
    ended = time.time() + 20
    while (new := {n for n in files() - before}) and time.time() < ended:
        time.sleep(0.2)
    assert len(new) <= 1  # the count's own
    labels = []

    def noted(df, label):
        labels.append(label)
        return staged(df, label)

    monkeypatch.setattr(pipeline, "staged", noted)
    run = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"a{i} {run} b{i}", "en", "s", 1) for i in range(3)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in pipeline.passages(spark, docs, SMALL).collect()}
    assert labels == ["spans"]
    assert got == {0: f"a0 {run} b0", 1: "a1 b1", 2: "a2 b2"}
