"""Family C: bid-log warehouse queries over bids derived from ``lineitem``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import user_agent
from larkspur.operators import bids as ops
from larkspur.plans import catalog, layouts
from larkspur.registry import register
from larkspur.session import scratch_path
from larkspur.sources import bids as src
from larkspur.sources import delimited
from larkspur.sources.tables import table


def bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.bids_from_lineitem(table(spark, sf_dir, "lineitem"))


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.cities_from_nation(table(spark, sf_dir, "nation"))


# ----------------------------------------------------------------- oracle SQL

def _sql_str(s):
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


_UA_VALUES = ",\n    ".join(
    f"({i}, {_sql_str(u)}, '{d}', '{o}', '{b}')"
    for i, (u, (d, o, b)) in enumerate(zip(src.USER_AGENTS, src.EXPECTED_UA)))

BIDS_SQL = f"""
ua(idx, useragent, device, os, browser) AS (VALUES
    {_UA_VALUES}),
bids AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS bidid,
         strftime(TIMESTAMP '2013-10-19' + to_seconds((l_orderkey % 10) * 86400
                  + (l_partkey * 37 + l_linenumber * 1009) % 86400), '%Y%m%d%H%M%S') || '000' AS ts,
         'py' || CAST(l_orderkey % 5000 AS VARCHAR) AS ipinyouid,
         ua.useragent, ua.device, ua.os, ua.browser,
         '10.' || CAST(l_suppkey % 256 AS VARCHAR) || '.' || CAST(l_partkey % 256 AS VARCHAR) || '.0' AS ip,
         CAST((l_suppkey % 25) % 5 AS VARCHAR) AS regionid,
         CASE WHEN l_orderkey % 97 = 0 THEN '' ELSE CAST(l_suppkey % 25 AS VARCHAR) END AS cityid,
         CAST(l_linenumber % 3 + 1 AS VARCHAR) AS adexchange,
         'd' || CAST(l_orderkey % 11 AS VARCHAR) || '.example' AS publicdomain,
         '' AS url, '' AS anonymousurl, 'slot' || CAST(l_partkey % 50 AS VARCHAR) AS adslotid,
         '300' AS adslotwidth, '250' AS adslotheight, 'FirstView' AS adslotvisibility, 'Fixed' AS adslotformat,
         CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) AS adslotfloorprice,
         'c' || CAST(l_partkey % 100 AS VARCHAR) AS creativeid,
         CAST(CAST(floor(l_extendedprice) AS BIGINT) % 300 AS VARCHAR) AS biddingprice,
         CAST(l_suppkey % 7 AS VARCHAR) AS advertiserid, '' AS userprofileids
  FROM lineitem JOIN ua ON ua.idx = (l_partkey + l_linenumber) % {len(src.USER_AGENTS)}),
bd AS (SELECT *, strftime(strptime(substr(ts, 1, 14), '%Y%m%d%H%M%S'), '%Y-%m-%d') AS bid_date FROM bids)
"""

_BID_COLS = ", ".join(f.name for f in src.BIDS_SCHEMA.fields)


def _top_sql(attr):
    return f"""SELECT cityid, {attr}, cnt FROM (
  SELECT cityid, {attr}, cnt, row_number() OVER (PARTITION BY cityid ORDER BY cnt DESC, {attr}) AS rnk
  FROM (SELECT cityid, {attr}, count({attr}) AS cnt FROM bids GROUP BY cityid, {attr})) WHERE rnk = 1"""


# ---------------------------------------------------------------- scans (S6, S7)

@register("bids_tsv_scan", f"WITH {BIDS_SQL} SELECT {_BID_COLS} FROM bids")
def bids_tsv_scan(spark, sf_dir):
    path = scratch_path(spark, "bids-tsv")
    delimited.write_tsv(bids(spark, sf_dir), path)
    return src.read_bids_tsv(spark, path, escapes=True)


@register("cities_tsv_scan", "SELECT CAST(n_nationkey AS INTEGER) AS id, n_name AS name FROM nation")
def cities_tsv_scan(spark, sf_dir):
    path = scratch_path(spark, "cities-tsv")
    delimited.write_tsv(cities(spark, sf_dir), path)
    return src.read_cities_tsv(spark, path, escapes=True)


# ---------------------------------------------------------- UA parsing (F2, G3)

@register("ua_enrich", f"WITH {BIDS_SQL} SELECT bidid, device, os, browser FROM bids")
def ua_enrich(spark, sf_dir):
    return user_agent.enrich(bids(spark, sf_dir).select("bidid", "useragent")).drop("useragent")


@register("ua_lateral", f"WITH {BIDS_SQL} SELECT bidid, device, os, browser FROM bids")
def ua_lateral(spark, sf_dir):
    with catalog.user_agents_view(spark, bids(spark, sf_dir)) as view:
        return spark.sql(f"SELECT bidid, device, os, browser FROM {view}")


@register("user_agents_view", f"WITH {BIDS_SQL} SELECT cityid, device, os, browser FROM bids")
def user_agents_view(spark, sf_dir):
    with catalog.temporary_database(spark, "logs", scratch_path(spark, "logs-db")), \
            catalog.user_agents_view(spark, bids(spark, sf_dir)) as view:
        return spark.sql(f"SELECT cityid, device, os, browser FROM {view}")


# --------------------------------------------------------- counts and ranks

def _counts(attr):
    def q(spark, sf_dir):
        return ops.city_value_counts(bids(spark, sf_dir), attr)
    q.__name__ = f"city_{attr}_counts"
    return q


def _top(attr):
    def q(spark, sf_dir):
        return ops.top_per_city(ops.city_value_counts(bids(spark, sf_dir), attr), attr)
    q.__name__ = f"city_top_{attr}"
    return q


for _a in ops.ATTRS:
    register(f"city_{_a}_counts",
             f"WITH {BIDS_SQL} SELECT cityid, {_a}, count({_a}) AS cnt FROM bids GROUP BY cityid, {_a}")(_counts(_a))
    register(f"city_top_{_a}", f"WITH {BIDS_SQL} {_top_sql(_a)}")(_top(_a))


@register("city_value_joinback", f"""WITH {BIDS_SQL},
d AS (SELECT cityid, device, count(device) AS cnt FROM bids GROUP BY cityid, device)
SELECT u.bidid, u.cityid, u.device, d.cnt FROM bids u JOIN d ON u.cityid = d.cityid AND u.device = d.device""")
def city_value_joinback(spark, sf_dir):
    b = bids(spark, sf_dir)
    view = user_agent.enrich(b.select("bidid", "cityid", "useragent")).select("bidid", "cityid", "device")
    counts = ops.city_value_counts(b, "device")         # rules once per distinct (city, user agent)
    return ops.joinback(view, counts, "device").select("bidid", "cityid", "device", "cnt")


@register("city_top_profile", f"""WITH {BIDS_SQL},
dev AS ({_top_sql('device')}), o AS ({_top_sql('os')}), br AS ({_top_sql('browser')})
SELECT c.n_name AS name, dev.device, o.os, br.browser
FROM nation c
JOIN dev ON c.n_nationkey = TRY_CAST(dev.cityid AS INTEGER)
JOIN o ON c.n_nationkey = TRY_CAST(o.cityid AS INTEGER)
JOIN br ON c.n_nationkey = TRY_CAST(br.cityid AS INTEGER)""")
def city_top_profile(spark, sf_dir):
    return ops.city_top_profile(bids(spark, sf_dir), cities(spark, sf_dir))


# ---------------------------------------------------- distributions (A10-A16)

for _q, _c in (("dist_ip", "ip"), ("dist_region", "regionid"), ("dist_advertiser", "advertiserid"),
               ("dist_exchange", "adexchange"), ("dist_domain", "publicdomain")):
    def _dist(spark, sf_dir, _c=_c):
        return ops.distribution(bids(spark, sf_dir), _c)
    _dist.__name__ = _q
    register(_q, f"WITH {BIDS_SQL} SELECT {_c}, count(*) AS cnt FROM bids GROUP BY {_c}")(_dist)


@register("dist_bid_date", f"WITH {BIDS_SQL} SELECT bid_date, count(*) AS cnt FROM bd GROUP BY bid_date")
def dist_bid_date(spark, sf_dir):
    return ops.distribution(ops.with_bid_date(bids(spark, sf_dir)), "bid_date")


_PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{k}' AS key_name, CAST({k} AS VARCHAR) AS value, count(*) AS rows FROM bd GROUP BY {k}"
    for k in ops.PROFILE_KEYS)


@register("partition_key_profile", f"""WITH {BIDS_SQL}, pv AS ({_PROFILE_SQL})
SELECT key_name, count(*) AS n_values, min(rows) AS min_rows, CAST(median(rows) AS DOUBLE) AS median_rows,
       max(rows) AS max_rows, CAST(sum(rows) AS BIGINT) AS total_rows
FROM pv GROUP BY key_name""")
def partition_key_profile(spark, sf_dir):
    return ops.partition_key_profile(bids(spark, sf_dir))


# ------------------------------------------------------ layouts (S15-S22)

def _layout_query(name, fmt, partition_by, buckets, sort_by=("useragent",), compression=None,
                  enriched=False, region_tinyint=False, rename_domain=False, bloom=(), via_insert=False):
    def q(spark, sf_dir):
        df = ops.with_bid_date(bids(spark, sf_dir))
        if region_tinyint:
            df = df.withColumn("regionid", F.col("regionid").try_cast("tinyint"))
        if rename_domain:
            df = df.withColumnRenamed("publicdomain", "domain")
        if partition_by != "bid_date":
            df = df.drop("bid_date")
        derived = user_agent.enrich if enriched else None
        schema = (derived(df) if derived else df).schema
        options = dict(fmt=fmt, partition_by=partition_by, buckets=buckets, sort_by=sort_by,
                       compression=compression, bloom_columns=bloom, derived=derived)
        # CREATE TABLE (empty) then INSERT OVERWRITE ... PARTITION(bid_date) SELECT ..., or both at once.
        with layouts.layout(spark, df.limit(0) if via_insert else df, name, **options) as (t, path):
            if via_insert:
                layouts.insert_overwrite(spark, df, t, partition_by=partition_by, bucket_by="cityid", buckets=buckets)
            return layouts.read_layout(spark, path, schema, fmt)
    q.__name__ = name
    return q


def _layout_sql(enriched=False, dated=True, renamed=False):
    """Every column of the layout: the bid, its date or tiny region, the parsed user agent."""
    cols = [{"regionid": "CAST(regionid AS TINYINT) AS regionid", "publicdomain": "publicdomain AS domain"}.get(c, c)
            if renamed else c for c in (f.name for f in src.BIDS_SCHEMA.fields)]
    cols += ["bid_date"] * dated + list(ops.ATTRS) * enriched
    return f"WITH {BIDS_SQL} SELECT {', '.join(cols)} FROM bd"


register("bids_layout_text", _layout_sql())(
    _layout_query("bids_layout_text", "csv", "bid_date", 2))
register("bids_layout_region", _layout_sql(dated=False))(
    _layout_query("bids_layout_region", "csv", "regionid", 2))
register("bids_layout_enriched", _layout_sql(enriched=True))(
    _layout_query("bids_layout_enriched", "csv", "bid_date", 4, enriched=True))
register("bids_layout_orc", _layout_sql())(
    _layout_query("bids_layout_orc", "orc", "bid_date", 4, sort_by=("cityid", "useragent"), via_insert=True))
register("bids_layout_orc_region", _layout_sql(dated=False, renamed=True))(
    _layout_query("bids_layout_orc_region", "orc", "regionid", 5, region_tinyint=True, rename_domain=True))
register("bids_layout_orc_plain", _layout_sql(dated=False, renamed=True))(
    _layout_query("bids_layout_orc_plain", "orc", "regionid", 5, compression="none",
                  region_tinyint=True, rename_domain=True))

LOOKUP_PREDICATE = "device = 'Tablet' OR browser = 'Opera Mini' OR os = 'Linux'"


@register("bids_lookup_bloom", f"""WITH {BIDS_SQL}
SELECT bidid, device, os, browser FROM bids WHERE {LOOKUP_PREDICATE}""")
def bids_lookup_bloom(spark, sf_dir):
    df = ops.with_bid_date(bids(spark, sf_dir))
    with layouts.layout(spark, df, "bids_lookup", fmt="orc", partition_by="bid_date", buckets=4, derived=user_agent.enrich,
                        sort_by=("device", "browser", "os"), bloom_columns=ops.ATTRS) as (_, path):
        return layouts.read_layout(spark, path, user_agent.enrich(df).schema).where(LOOKUP_PREDICATE).select("bidid", *ops.ATTRS)
