import random
import statistics

from larkspur.operators import bids as ops
from larkspur.sources import delimited
from larkspur.session import scratch_path
from larkspur.sources.bids import BIDS_SCHEMA, read_bids_tsv

CHROME = "Mozilla/5.0 (Windows NT 6.1) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/30.0 Safari/537.36"
IPAD = "Mozilla/5.0 (iPad; CPU OS 8_4_1 like Mac OS X) AppleWebKit/600.1.4 (KHTML, like Gecko) Version/8.0 Mobile/12H321 Safari/600.1.4"
FOX = "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:24.0) Gecko/20100101 Firefox/24.0"


def test_top_per_city_breaks_ties_by_value(spark):
    counts = spark.createDataFrame([("1", "b", 3), ("1", "a", 3), ("1", "c", 1), ("2", "z", 1)],
                                   "cityid string, device string, cnt long")
    got = sorted(tuple(r) for r in ops.top_per_city(counts, "device").collect())
    assert got == [("1", "a", 3), ("2", "z", 1)]


def test_city_top_profile(spark):
    bids = spark.createDataFrame([("1", CHROME), ("1", CHROME), ("1", IPAD), ("2", FOX), ("x", FOX), ("3", FOX)],
                                 "cityid string, useragent string")
    cities = spark.createDataFrame([(1, "Oslo"), (2, "Lima")], "id int, name string")
    got = sorted(tuple(r) for r in ops.city_top_profile(bids, cities).collect())
    assert got == [("Lima", "Computer", "Ubuntu", "Firefox 24"), ("Oslo", "Computer", "Windows 7", "Chrome 30")]


def test_key_profile_exact_median(spark):
    rnd = random.Random(7)
    vals = [(str(rnd.randint(0, 30)), str(rnd.randint(0, 3))) for _ in range(500)]
    df = spark.createDataFrame(vals, "ip string, regionid string")
    got = {r.key_name: r for r in ops.partition_key_profile(df, keys=("ip", "regionid")).collect()}
    for i, k in enumerate(("ip", "regionid")):
        per = {}
        for v in vals:
            per[v[i]] = per.get(v[i], 0) + 1
        c = list(per.values())
        r = got[k]
        assert (r.n_values, r.min_rows, r.max_rows, r.total_rows) == (len(c), min(c), max(c), 500)
        assert r.median_rows == float(statistics.median(c))


def test_tsv_round_trip_keeps_empty_and_null(spark):
    row = tuple([""] * 21)
    row2 = ("b2",) + (None,) * 20
    df = spark.createDataFrame([row, row2], BIDS_SCHEMA)
    path = scratch_path(spark, "t-tsv")
    delimited.write_tsv(df, path)
    got = sorted((tuple(r) for r in read_bids_tsv(spark, path).collect()), key=str)
    assert sorted([row, row2], key=str) == got


def test_flagship_plan_shape(spark, sf_dir):
    """Scan prunes to the needed columns; UA rules run after the (cityid, useragent)
    pre-aggregate; the rank is a WindowGroupLimit; cities are broadcast."""
    import __spark_entry__ as ent
    df = ent.queries()["city_top_profile"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    schemas = [ln for ln in plan.splitlines() if "ReadSchema" in ln and "l_orderkey" in ln]
    assert schemas and all("l_extendedprice" not in ln and "l_shipdate" not in ln for ln in schemas)
    # The regex chain sits above the first aggregation, never directly over the scan.
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    first_rlike = opt.find("RLIKE")
    last_agg = opt.rfind("Aggregate [cityid")
    assert first_rlike != -1 and last_agg != -1 and first_rlike < last_agg


def test_counts_parse_distinct_pairs_only(spark):
    bids = spark.createDataFrame([("1", CHROME)] * 5 + [("1", IPAD), ("2", FOX)], "cityid string, useragent string")
    got = sorted(tuple(r) for r in ops.city_value_counts(bids, "device").collect())
    assert got == [("1", "Computer", 5), ("1", "Tablet", 1), ("2", "Computer", 1)]
