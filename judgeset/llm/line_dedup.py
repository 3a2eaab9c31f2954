"""Line dedup: drop lines that too large a share of their host's pages contain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from judgeset.llm._tables import Scratch, fresh, table

BLANKS = " \t\n\x0b\x0c\r"
BLOCKS = "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"
HIDDEN_HTML = "(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<!--.*?-->"
BREAKS_HTML = f"(?i)</?(?:{BLOCKS})(?:\\s[^>]*)?/?>"
TAGS_HTML = "<[^>]*>"
HOST = "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"


def url_host(url: Column) -> Column:
    """Lower-case host of a URL; null if it has none."""
    found = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(found != "", found)


def html_lines(html: Column) -> Column:
    """Visible text of a page with a line per block element."""
    shown = F.regexp_replace(F.regexp_replace(html, HIDDEN_HTML, ""), BREAKS_HTML, "\n")
    return F.regexp_replace(shown, TAGS_HTML, "")


def drop_boilerplate_lines(df: DataFrame, host: str = "host", text: str = "text", max_ratio: float = 0.1, min_pages: int = 2) -> DataFrame:
    """df with the text freed of its host's boilerplate, plus n_lines and n_dropped (long; columns of these names go).

    A line is boilerplate on a host if it stands on more than max_ratio of the host's pages, and on min_pages of them at
    least: with the usual 2, a host with a single page loses nothing. A page counts once per line. Lines are compared
    without outer blanks, by 64-bit hash within a host; lines without a word are neither counted nor dropped. Pages
    whose host is null belong to no site and stay as they are, as do null texts (no lines). Repeated rows are pages of
    their own. Every other column is passed on; columns of df may have any names. An empty table gives no rows.

    Only (host, line hash) rows are shuffled to find boilerplate, summed up before the shuffle. A host has at most (mean
    lines per page) / max_ratio boilerplate lines whatever its size: one bounded row per host, in a written table of
    known size. Spark broadcasts that table while it is small; beyond that it joins on the host and splits hot hosts.
    """
    scratch = Scratch(df.sparkSession, "lines")
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    trimmed = lambda x: F.btrim(x, F.lit(BLANKS))
    key = lambda x: F.xxhash64(trimmed(x))
    named = F.filter(F.transform(lines, trimmed), lambda x: x != "")
    pages = df.filter(F.col(host).isNotNull()).select(F.col(host).cast("string").alias("site"), F.array_distinct(F.transform(named, lambda x: F.xxhash64(x))).alias("keys"))
    # a host's pages are counted in the same pass, as a line without key
    seen = pages.select("site", F.explode(F.concat(F.array(F.lit(None).cast("long")), "keys")).alias("key")).groupBy("site", "key").agg(F.count(F.lit(1)).alias("on"))
    seen = scratch.keep(seen.filter(F.col("key").isNull() | (F.col("on") >= min_pages)), "seen")
    totals = seen.filter(F.col("key").isNull()).select("site", F.col("on").alias("pages"))
    common = seen.filter(F.col("key").isNotNull()).join(totals, "site").filter(F.col("on") > F.lit(max_ratio) * F.col("pages"))
    site, boiler, left = fresh(df, "site", "boiler", "left")
    sites = scratch.keep(common.groupBy(F.col("site").alias(site)).agg(F.collect_list("key").alias(boiler)), "sites")
    scratch.drop(seen)

    joined = df.withColumn(site, F.col(host).cast("string")).join(sites, site, "left")
    stays = lambda x: ~F.array_contains(boiler, key(x)) | (trimmed(x) == "")
    marked = joined.withColumn(left, F.when(F.col(boiler).isNotNull(), F.filter(lines, stays)))
    n_lines = F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long")
    n_dropped = F.when(F.col(text).isNull() | F.col(left).isNull(), 0).otherwise(F.size(lines) - F.size(left)).cast("long")
    cleaned = F.when(n_dropped == 0, F.col(text)).otherwise(F.array_join(left, "\n")).alias(text)
    kept = [cleaned if c == text else F.col(c) for c in df.columns if c.lower() not in ("n_lines", "n_dropped")]
    return marked.select(*kept, n_lines.alias("n_lines"), n_dropped.alias("n_dropped"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as lines of text, without its host's boilerplate."""
    pages = table(spark, sf_dir, "pages").select("page_id", url_host(F.col("url")).alias("host"), html_lines(F.col("html")).alias("text"))
    return drop_boilerplate_lines(pages)


def _sql(max_ratio: float = 0.1, min_pages: int = 2) -> str:
    trim = "regexp_replace(regexp_replace(l, '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+$', '')"
    return f"""
WITH pages0 AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '{HOST}', 1)), '') AS host,
    regexp_replace(regexp_replace(regexp_replace(html, '{HIDDEN_HTML}', '', 'g'), '{BREAKS_HTML}', chr(10), 'g'), '{TAGS_HTML}', '', 'g') AS text
  FROM pages),
numbered AS (SELECT row_number() OVER () AS r, * FROM pages0),
lines AS (SELECT r, host, i, l, {trim} AS k FROM (SELECT r, host, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM numbered WHERE text IS NOT NULL)),
totals AS (SELECT host, count(*) AS pages FROM numbered WHERE host IS NOT NULL GROUP BY host),
boiler AS (
  SELECT s.host, s.k FROM (SELECT host, k, count(DISTINCT r) AS seen FROM lines WHERE host IS NOT NULL AND k <> '' GROUP BY host, k) s
  JOIN totals USING (host) WHERE seen >= {min_pages} AND seen > {max_ratio}::DOUBLE * pages),
left_ AS (
  SELECT l.r, count(*) AS n_lines, count(b.k) AS n_dropped, string_agg(l.l, chr(10) ORDER BY l.i) FILTER (WHERE b.k IS NULL) AS text
  FROM lines l LEFT JOIN boiler b ON l.host = b.host AND l.k = b.k GROUP BY l.r)
SELECT n.page_id, n.host, CASE WHEN n.text IS NULL THEN NULL ELSE coalesce(x.text, '') END AS text,
  CAST(coalesce(x.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(x.n_dropped, 0) AS BIGINT) AS n_dropped
FROM numbered n LEFT JOIN left_ x ON n.r = x.r
"""


OP2_SQL = _sql()
