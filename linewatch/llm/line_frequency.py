"""Drops lines that stand on too large a share of a host's pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linewatch.llm.common import table

#: A line goes when more than this share of its host's pages hold it ...
MAX_RATIO = 0.3
#: ... and at least so many pages do: a line that only one page has is no repetition.
MIN_PAGES = 2

#: Where a page's markup breaks into lines; scripts, styles and comments are breaks as a whole.
MARKUP = r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>|\n"
HOST = r"^[a-zA-Z]+://([^/?#]+)"


def _digest(host: Column, line: Column) -> tuple[Column, Column]:
    """128 bits for a line of a host; the line itself is not shuffled."""
    return F.xxhash64(host, line), F.xxhash64(F.lit("line"), host, line)


def _line_rows(pages: DataFrame, *columns: str) -> DataFrame:
    """A row for each different line with text of each page."""
    lines = F.array_distinct(F.filter(
        F.transform("_lines", lambda x: F.trim(x)), lambda x: F.length(x) > 0))
    rows = pages.select(*columns, "_host", F.explode(lines).alias("_line"))
    first, second = _digest(F.col("_host"), F.col("_line"))
    return rows.select(*columns, "_host", first.alias("_d1"), second.alias("_d2"))


def boilerplate(pages: DataFrame, max_ratio: float, min_pages: int) -> DataFrame:
    """The digests of all boilerplate lines of pages with _host and _lines."""
    totals = pages.groupBy("_host").agg(F.count(F.lit(1)).alias("_total"))
    counts = _line_rows(pages).groupBy("_d1", "_d2").agg(
        F.count(F.lit(1)).alias("_pages"), F.max("_host").alias("_host"))
    return counts.where(F.col("_pages") >= min_pages).join(totals, "_host").where(
        F.col("_pages") > F.lit(float(max_ratio)) * F.col("_total")).select("_d1", "_d2")


def drop_boilerplate(
    pages: DataFrame, key: str, host: Column, lines: Column,
    max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, counted: DataFrame | None = None,
) -> DataFrame:
    """pages with n_lines, n_dropped and kept_lines (array, null where lines is null).

    Lines are compared without spaces at their ends; blank lines count for nothing and stay. Every
    row is a page, also a repeated one. A null host is a host; a null key is a key. Columns of
    pages named kept_lines, n_lines or n_dropped are replaced. No page is dropped. counted: the pages
    that the ratio is taken over, all of them if not given.

    Only digests and counts are shuffled; texts move once, and only if pages with dropped lines
    are too many to send to the scans. A host or a line with a third of all rows is combined
    before the shuffle; in the joins nothing is grouped by host.
    """
    # hosts are 64-bit digests, so that aggregation buffers have a fixed width
    def cut(df: DataFrame) -> DataFrame:
        return df.drop("kept_lines", "n_lines", "n_dropped").withColumns(
            {"_host": F.xxhash64(F.coalesce(host, F.lit("\0"))), "_lines": lines})

    work = cut(pages)
    hits = _line_rows(work, key).join(
        boilerplate(work if counted is None else cut(counted), max_ratio, min_pages), ["_d1", "_d2"], "left_semi")
    by_page = hits.groupBy(F.col(key).alias("_key"), F.col("_host").alias("_of")).agg(
        F.collect_set("_d1").alias("_gone"))
    gone = F.coalesce("_gone", F.array().cast("array<bigint>"))
    kept = F.filter("_lines", lambda x: ~F.array_contains(
        gone, _digest(F.col("_host"), F.trim(x))[0]) | (F.length(F.trim(x)) == 0))
    return work.join(
        by_page, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_host") == F.col("_of")), "left",
    ).withColumn("kept_lines", F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(kept)
    ).select(
        *[c for c in pages.columns if c not in ("kept_lines", "n_lines", "n_dropped")],
        "kept_lines", F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
        (F.coalesce(F.size("_lines"), F.lit(0)) - F.coalesce(F.size("kept_lines"), F.lit(0)))
        .cast("long").alias("n_dropped"))


def page_lines(html: Column) -> Column:
    """Texts between tags and line breaks, without blank ones."""
    return F.filter(F.split(html, MARKUP, -1), lambda x: F.length(F.trim(x)) > 0)


def op10_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages with the lines that stay; the host comes from the address."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.lower(F.regexp_extract("url", HOST, 1)).alias("host"), "html")
    return drop_boilerplate(pages, "page_id", F.col("host"), page_lines(F.col("html"))).select(
        "page_id", "host", "n_lines", "n_dropped",
        F.array_join("kept_lines", "\n").alias("kept_text"))


OP10_SQL = rf"""
with cut as (
  select page_id, lower(regexp_extract(url, '{HOST}', 1)) as host,
         list_filter(string_split_regex(html, '{MARKUP}'), lambda x: length(trim(x)) > 0) as lines
  from pages),
totals as (select host, count(*) as total from cut group by host),
counts as (
  select host, line, count(*) as n
  from (select host, unnest(list_distinct(list_transform(lines, lambda x: trim(x)))) as line from cut)
  group by host, line),
gone as (
  select host, list(line) as gone from counts join totals using (host)
  where n >= {MIN_PAGES} and n > {MAX_RATIO}::double * total group by host),
done as (
  select page_id, host, lines, list_filter(lines, lambda x: not list_contains(coalesce(gone, []), trim(x))) as kept
  from cut left join gone using (host))
select page_id, host, coalesce(len(lines), 0) as n_lines,
       coalesce(len(lines), 0) - coalesce(len(kept), 0) as n_dropped,
       array_to_string(kept, chr(10)) as kept_text
from done
"""
