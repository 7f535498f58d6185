"""Family D: hotels for couples over booking lines derived from the TPC-H tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import couples
from larkspur.registry import register
from larkspur.session import scratch_path
from larkspur.sources import bookings
from larkspur.sources.tables import table


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    return bookings.booking_lines(t("lineitem"), t("supplier"), t("nation"), t("region"), t("part"))


def stored_lines(spark: SparkSession, sf_dir: str) -> str:
    """Write the lines as text files in the shared folder; returns the glob."""
    path = scratch_path(spark, "bookings")
    lines(spark, sf_dir).write.text(path)
    return f"{path}/part-*"


_LINES_SQL = """
j AS (
  SELECT l.l_orderkey AS ok, l.l_partkey AS pk, l.l_linenumber AS ln, r.r_name, n.n_name, p.p_brand
  FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
  JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
  JOIN part p ON p.p_partkey = l.l_partkey),
kept AS (
  SELECT CASE WHEN ok % 17 = 0 THEN '' ELSE r_name END AS continent,
         CASE WHEN ok % 17 = 0 THEN '' ELSE n_name END AS country,
         CASE WHEN ok % 17 = 0 OR ok % 19 = 0 THEN '' ELSE p_brand END AS market
  FROM j WHERE ok % 13 <> 0 AND ok % 29 <> 0 AND ln = 2 AND pk % 11 <> 0),
counts AS (
  SELECT continent || '#' || country || '#' || market AS market_key, count(*) AS cnt FROM kept
  WHERE continent || '#' || country || '#' || market <> '##' GROUP BY 1)
"""


@register("booking_lines_parse", f"WITH {_LINES_SQL} SELECT continent, country, market FROM kept")
def booking_lines_parse(spark, sf_dir):
    return bookings.parse_couples(spark.read.text(stored_lines(spark, sf_dir)))


@register("couples_market_counts", f"WITH {_LINES_SQL} SELECT market_key, cnt FROM counts")
def couples_market_counts(spark, sf_dir):
    return couples.market_counts(bookings.parse_couples(spark.read.text(stored_lines(spark, sf_dir))))


@register("couples_partial_merge", f"WITH {_LINES_SQL} SELECT market_key, cnt FROM counts")
def couples_partial_merge(spark, sf_dir):
    src = spark.read.text(stored_lines(spark, sf_dir)).withColumn("split", F.input_file_name())

    partial_dir = scratch_path(spark, "couples-partials")
    couples.partial_counts(src, lambda df: bookings.parse_couples(df, keep=("split",))).write.text(partial_dir)
    return couples.merge_partials(spark.read.text(f"{partial_dir}/part-*"))


@register("couples_top_markets", f"WITH {_LINES_SQL} SELECT market_key, cnt FROM counts ORDER BY cnt DESC, market_key LIMIT 3")
def couples_top_markets(spark, sf_dir):
    counts = couples.market_counts(bookings.parse_couples(spark.read.text(stored_lines(spark, sf_dir))))
    return couples.top_markets(counts)


@register("couples_bottom_markets", f"WITH {_LINES_SQL} SELECT market_key, cnt FROM counts ORDER BY cnt ASC, market_key LIMIT 3")
def couples_bottom_markets(spark, sf_dir):
    counts = couples.market_counts(bookings.parse_couples(spark.read.text(stored_lines(spark, sf_dir))))
    return couples.top_markets(counts, ascending=True)


@register("top_markets_text", f"""WITH {_LINES_SQL}
SELECT market_key || ' : ' || CAST(cnt AS VARCHAR) AS line FROM (
  SELECT market_key, cnt FROM counts ORDER BY cnt DESC, market_key LIMIT 3)""")
def top_markets_text(spark, sf_dir):
    counts = couples.market_counts(bookings.parse_couples(spark.read.text(stored_lines(spark, sf_dir))))
    out = scratch_path(spark, "top-markets")
    # Three lines: a single output file is the result format, not a bottleneck.
    couples.result_lines(couples.top_markets(counts)).coalesce(1).write.text(out)
    return spark.read.text(out).withColumnRenamed("value", "line")
