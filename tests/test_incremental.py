"""Stored state brought up to date: split partials, user-agent dictionary, city partials, day sketches, clustered files."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from larkspur.functions import user_agent
from larkspur.operators import bids as ops
from larkspur.operators import sketches
from larkspur.plans import clustered, ua_dictionary
from larkspur.plans.city_partials import CityPartials
from larkspur.plans.queries_bids import bids
from larkspur.plans.split_partials import SplitPartials
from larkspur.session import scratch_path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ------------------------------------------------------------------ split partials

def booking(key, adults="2"):
    v = [""] * 22
    v[11] = adults
    v[18:21] = key.split("#")
    return ",".join(v)


def write_text(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_a_split_read_again_replaces_its_own(spark, tmp_path):
    lines = f"{tmp_path}/lines"
    write_text(lines, "a.txt", [booking("E#FR#m1")] * 3 + [booking("E#FR#m2"), booking("##"), booking("E#FR#m1", "1"), "short"])
    write_text(lines, "b.txt", [booking("E#DE#m1")] * 2)
    p = SplitPartials(spark, scratch_path(spark, "t-split"))
    assert p.counts().count() == 0
    p.load(lines)
    want = [("E#DE#m1", 2), ("E#FR#m1", 3), ("E#FR#m2", 1)]
    assert rows(p.counts()) == want
    p.load(lines)                                                          # every split again
    p.load(lines, F.col("file").endswith("b.txt"))                         # one split again
    assert rows(p.counts()) == want
    write_text(lines, "b.txt", ["nothing to count"])                       # the split has changed
    p.load(lines, F.col("file").endswith("b.txt"))
    assert rows(p.counts()) == want[1:]
    assert len(rows(p.partials().select("file").distinct())) == 2


def test_a_run_that_failed_is_not_read_and_is_written_over(spark, tmp_path):
    lines = f"{tmp_path}/lines"
    write_text(lines, "a.txt", [booking("E#FR#m1")])
    p = SplitPartials(spark, scratch_path(spark, "t-split"))
    assert p.load(lines) == 0
    p.load(lines)
    os.remove(f"{p._run(1)}/_SUCCESS")
    assert p._runs() == [0] and rows(p.counts()) == [("E#FR#m1", 1)]
    assert p.load(lines) == 1 and rows(p.counts()) == [("E#FR#m1", 1)]


def test_blocks_of_one_file_are_splits_of_their_own(spark, tmp_path):
    lines, key = f"{tmp_path}/lines", "spark.sql.files.maxPartitionBytes"
    write_text(lines, "a.txt", [booking(f"E#FR#m{i % 3}") for i in range(400)])
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "4096b")
        p = SplitPartials(spark, scratch_path(spark, "t-split"))
        p.load(lines)
        blocks = [r["block"] for r in p.partials().select("block").distinct().collect()]
        p.load(lines, F.col("block") == max(blocks))
        assert len(blocks) > 1 and sum(n for _, n in rows(p.counts())) == 400
        spark.conf.set(key, "8192b")
        with pytest.raises(ValueError):
            p.load(lines)
    finally:
        spark.conf.set(key, before)


# ------------------------------------------------------------------ user-agent dictionary

def test_each_user_agent_is_parsed_once_per_version(spark, sf_dir, monkeypatch):
    b = bids(spark, sf_dir).select("bidid", "useragent")
    distinct = b.where(F.col("useragent").isNotNull()).select("useragent").distinct().count()
    root = scratch_path(spark, "t-ua")
    some = b.where(F.col("useragent").contains("Windows"))
    first = ua_dictionary.refresh(spark, root, some)
    assert 0 < first < distinct
    assert ua_dictionary.refresh(spark, root, b) == distinct - first
    assert ua_dictionary.refresh(spark, root, b) == 0
    assert rows(ua_dictionary.enrich(b, root)) == rows(user_agent.enrich(b).select("bidid", "useragent", "device", "os", "browser"))
    assert not ua_dictionary.enrich(b, root)._jdf.queryExecution().optimizedPlan().toString().count("RLIKE")
    monkeypatch.setattr(user_agent, "BROWSER_RULES", [("Firefox", "Fox"), *user_agent.BROWSER_RULES])
    assert ua_dictionary.refresh(spark, root, b) == distinct                # new rules: nothing is known
    assert rows(ua_dictionary.enrich(b, root)) == rows(user_agent.enrich(b).select("bidid", "useragent", "device", "os", "browser"))


# ------------------------------------------------------------------ city partials

def day(spark, sf_dir):
    return ops.with_bid_date(bids(spark, sf_dir)).select("bidid", "cityid", "useragent", "bid_date")


def full(b):
    return rows(CityPartials.ranked(b.groupBy("cityid", "useragent").agg(F.count("*").alias("n"))).select("cityid", "kind", "value", "cnt"))


def test_loading_and_replacing_days_equals_a_recount(spark, sf_dir):
    b = day(spark, sf_dir).withColumn("cityid", F.when(F.col("cityid") == "3", F.lit(None)).otherwise(F.col("cityid")))
    store = CityPartials(spark, scratch_path(spark, "t-city"))
    first, later = b.where("bid_date < '2013-10-24'"), b.where("bid_date >= '2013-10-24'")
    store.load(first)
    assert rows(store.top()) == full(first)
    store.load(later)
    assert rows(store.top()) == full(b)
    one_city = b.where("bid_date <> '2013-10-25' OR cityid = '7'")          # the day shrinks to one city
    store.load(b.where("bid_date = '2013-10-25' AND cityid = '7'"))
    assert rows(store.top()) == full(one_city)
    store.load(b.where("bid_date = '2013-10-25'"))
    assert rows(store.top()) == full(b)


def test_only_cities_of_the_loaded_day_are_ranked_again(spark, sf_dir):
    b = day(spark, sf_dir)
    store = CityPartials(spark, scratch_path(spark, "t-city"))
    store.load(b.where("cityid IN ('1', '2', '4')"))
    assert store.load(b.where("cityid = '2' AND bid_date = '2013-10-20'").limit(5).withColumn("bid_date", F.lit("2013-11-30"))) == 1
    assert len(glob.glob(f"{store.root}/top/*")) <= 2 and not os.path.exists(f"{store.root}/pending")


@pytest.mark.parametrize("at", [1, 2, 3, 4])
def test_a_load_that_failed_is_repeated(spark, sf_dir, monkeypatch, at):
    b = day(spark, sf_dir).where("cityid IN ('1', '2')")
    store = CityPartials(spark, scratch_path(spark, "t-city"))
    store.load(b)
    reloaded = b.where("bid_date = '2013-10-20' AND cityid = '1'")
    from pyspark.sql.readwriter import DataFrameWriter
    real, calls = DataFrameWriter.parquet, []

    def crash(self, *args, **kwargs):
        calls.append(1)
        if len(calls) == at:
            raise RuntimeError("crash")
        return real(self, *args, **kwargs)
    monkeypatch.setattr(DataFrameWriter, "parquet", crash)
    with pytest.raises(RuntimeError):
        store.load(reloaded)
    monkeypatch.setattr(DataFrameWriter, "parquet", real)
    store.load(reloaded)
    assert rows(store.top()) == full(b.where("bid_date <> '2013-10-20' OR cityid = '1'"))


# ------------------------------------------------------------------ sketches

def test_merged_sketches_are_near_the_exact_profile(spark):
    b = spark.range(200_000).selectExpr(
        "concat('2024-01-0', 1 + id % 4) as bid_date", "cast(pow(pmod(xxhash64(id), 1000000) / 1000000.0, 3) * 3000 as int) as ip")
    days = sketches.day_sketches(b, ("ip",))
    assert days.count() == 4
    for chosen in (["2024-01-01"], ["2024-01-02", "2024-01-04"], [f"2024-01-0{d}" for d in range(1, 5)]):
        some = b.where(F.col("bid_date").isin(chosen))
        (p,) = sketches.range_profile(days.where(F.col("bid_date").isin(chosen))).collect()
        exact = {r["rows"]: (r["below"], r["upto"]) for r in sketches.exact_profile(some, ("ip",)).collect()}
        below, upto = exact[p["median_rows"]]
        assert below <= 0.5 + 0.02 and upto >= 0.5 - 0.02                   # the rank error of the estimated median
        values = some.select("ip").distinct().count()
        assert abs(p["n_values"] - values) <= 0.04 * values
        assert (p["min_rows"], p["max_rows"]) == (min(exact), max(exact)) and p["total_rows"] == some.count()


# ------------------------------------------------------------------ clustered files

def test_a_lookup_opens_few_files(spark, sf_dir):
    b = day(spark, sf_dir)
    path = scratch_path(spark, "t-zorder")
    clustered.write_clustered(b, path, ("cityid", "useragent", "bid_date"), 32)
    agent = b.where("useragent like '%Firefox%'").first()["useragent"]
    for ranges in ({"cityid": ("7", "7"), "bid_date": ("2013-10-21", "2013-10-22")}, {"useragent": (agent, agent), "cityid": ("12", "12")}):
        files, total = clustered.files_for(spark, path, ranges)
        want = b
        for c, (low, high) in ranges.items():
            want = want.where(F.col(c).between(low, high))
        got = clustered.read_clustered(spark, path, b.schema, ranges)
        assert rows(got) == rows(want) and total >= 30
        assert len(files) <= total / 3, (len(files), total)
        opened = {r[0] for r in got.select(F.input_file_name()).distinct().collect()}
        assert len(opened) <= len(files)
    assert clustered.read_clustered(spark, path, b.schema, {"cityid": ("nowhere", "nowhere")}).count() == 0


def test_clustering_of_nulls_one_value_and_nothing(spark):
    for data in ([(None, 1, "x")] * 50 + [("a", None, "y")] * 50, [("a", 1, "x")] * 100, []):
        df = spark.createDataFrame(data, "c string, n int, v string")
        path = scratch_path(spark, "t-zorder")
        clustered.write_clustered(df, path, ("c", "n"), 4)
        assert rows(spark.read.schema(df.schema).parquet(path)) == rows(df)
        assert clustered.read_clustered(spark, path, df.schema, {"c": ("a", "a")}).count() == sum(r[0] == "a" for r in data)


def test_bits_interleave(spark):
    key = clustered.interleaved([F.lit(0b101), F.lit(0b011)], 3)
    assert spark.range(1).select(key).first()[0] == 0b100111
    cuts = [10, 20, 30]
    got = spark.createDataFrame([(i,) for i in (5, 10, 19, 20, 30, 99)], "v int").select(clustered.bucket(F.col("v"), cuts, 2)).collect()
    assert [r[0] for r in got] == [0, 1, 1, 2, 3, 3]
