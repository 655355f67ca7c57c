"""A corpus made ready for training: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from linewatch.llm import (
    cutting_stock, line_frequency, multi_order_join, span_language, sparse_suffixes,
)
from linewatch.llm.common import hinted, staged, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document stays if at least this share of it is in one language.
LEAST_SCORE = 0.5
#: A line goes when more than this share of its source's documents hold it. A source is far larger
#: than a host: the commonest line has 0.086 to 0.132 of one at sf0.1, any other 0.048 at most.
SOURCE_RATIO = 0.08
#: ... and at least so many of them.
SOURCE_DOCUMENTS = 5


def _measured(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", "lang", "source",
                       F.char_length("text").cast("long").alias("n_chars"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of a learned language. Null texts and texts without a letter go, and those
    with less than half of their words in one language. `lang` stays as given."""
    model = span_language.learn(
        docs.where(~span_language.held_out("doc_id")), "doc_id", "text", "lang")
    found = span_language.predicted(docs.select(*COLUMNS), "text", model)
    return found.where((F.col("lang_pred") != span_language.UNKNOWN)
                       & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def _copies(docs: DataFrame, *by: str) -> DataFrame:
    """(doc_id): documents whose text one of a smaller id has too, among those of equal `by`."""
    digest = [F.xxhash64("text").alias("_t1"), F.xxhash64(F.lit("text"), "text").alias("_t2")]
    narrow = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        "doc_id", *[F.xxhash64(F.coalesce(c, F.lit("\0"))).alias(f"_b{i}") for i, c in enumerate(by)],
        *digest)
    keys = narrow.columns[1:]
    first = narrow.groupBy(*keys).agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last")
                                      ).where("_first <> _last").drop("_last")
    return hinted(staged(narrow.join(first, keys).where("doc_id <> _first").select(
        "doc_id").distinct(), "copies"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops boilerplate lines of each source; a document all of whose words go, goes. Lines are
    counted over different texts: copies of one text are one document of its source, so they
    make none of its lines boilerplate."""
    lines = line_frequency.drop_boilerplate(
        docs.select(*COLUMNS), "doc_id", F.col("source"), F.split("text", "\n", -1),
        max_ratio=SOURCE_RATIO, min_pages=SOURCE_DOCUMENTS,
        counted=docs.select(*COLUMNS).join(_copies(docs, "source"), "doc_id", "left_anti"))
    kept = lines.withColumn("text", F.when(F.col("n_dropped") > 0, F.array_join("kept_lines", "\n"))
                            .otherwise(F.col("text")))
    return _measured(kept.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of documents linked by a similarity of 0.8 of their
    sets of five-word shingles. Documents without words or without an id stay. Repeated rows are one
    document; documents that share an id but not the text all stay, as do their links' others."""
    groups = multi_order_join.similarity_groups(docs, "doc_id", "text", 5, 80)
    shared = hinted(staged(docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("_n")).where("_n > 1").select("doc_id"), "shared-ids"))
    gone = groups.where((F.col("n_shingles") > 0) & (F.col("component_id") != F.col("doc_id"))
                        ).select("doc_id").distinct()
    rows = docs.select(*COLUMNS)
    # few rows share an id, so few are compared as wholes
    several = rows.join(shared, "doc_id", "left_semi").dropDuplicates()
    clashing = several.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(
        "doc_id")
    gone = gone.join(clashing, "doc_id", "left_anti")
    return rows.join(shared, "doc_id", "left_anti").unionByName(several).join(
        gone, "doc_id", "left_anti").select(*COLUMNS)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words and more that a document of a smaller id has too. A document
    of which nothing is left goes."""
    spans = staged(sparse_suffixes.repeated_passages(docs, "doc_id", "text").where(
        ~F.col("first")), "spans")
    return _measured(sparse_suffixes.without_spans(docs.select(*COLUMNS), "doc_id", "text", spans))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens."""
    return cutting_stock.packed(docs, "doc_id", "text", *cutting_stock.word_vocabulary())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("passages", passages),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's rows are written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The language scores and the packing have no SQL; tests hold them against brute force.
ORACLE_SQL = None
