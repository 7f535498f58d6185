import json

from pyspark.sql import functions as F

from larkspur.operators import hashtags
from larkspur.sources.topic import RECORD_SCHEMA

T0 = 1704103200  # 2024-01-01 10:00:00 UTC


def status(tags=None, created="Mon Jan 01 09:05:00 +0000 2024", place="US", name="ann", drop=()):
    st = {"created_at": created, "text": "t", "user": {"name": name},
          "place": None if place is None else {"country_code": place},
          "entities": {"hashtags": [{"text": t, "indices": [0, 1]} for t in (tags or [])]}}
    for d in drop:
        if d == "hashtags":
            del st["entities"]["hashtags"]
        else:
            del st[d]
    return json.dumps(st)


def recs(spark, values, ts=T0):
    return spark.createDataFrame([("k", v, "tw", 0, i, ts, 0) for i, v in enumerate(values)], RECORD_SCHEMA)


def test_explode_counts_each_hashtag(spark):
    rows = hashtags.explode_hashtags(recs(spark, [status(["a", "b"]), status(["a"])]), keep=()).collect()
    assert sorted((r.date, r.hour, r.hashtag) for r in rows) == [
        ("2024-01-01", "10", "a"), ("2024-01-01", "10", "a"), ("2024-01-01", "10", "b")]


def test_no_rows_for_empty_absent_bad_or_null(spark):
    values = [status([]), status(drop=("hashtags",)), status(drop=("entities",)), "{broken", None]
    assert hashtags.explode_hashtags(recs(spark, values)).count() == 0
    assert hashtags.explode_hashtags_created(recs(spark, values)).count() == 0


def test_nested_status_hashtags_are_ignored(spark):
    v = json.loads(status(["top"]))
    v["retweeted_status"] = {"entities": {"hashtags": [{"text": "inner", "indices": [0, 1]}]}}
    rows = hashtags.explode_hashtags(recs(spark, [json.dumps(v)])).collect()
    assert [r.hashtag for r in rows] == ["top"]


def test_hourly_counts_zero_padded_hour(spark):
    out = hashtags.batch_hourly_counts(recs(spark, [status(["x"])] * 3, ts=1704099600 - 3600 * 1 + 60))
    assert [(r.date, r.hour, r.hashtag, r.cnt) for r in out.collect()] == [("2024-01-01", "08", "x", 3)]


def test_created_at_dating_and_bad_dates(spark):
    values = [status(["a"], created="Mon Jan 01 09:05:00 +0000 2024"), status(["a"], created="yesterday")]
    rows = hashtags.explode_hashtags_created(recs(spark, values)).collect()
    assert [(r.date, r.hour) for r in rows] == [("2024-01-01", "09")]
    unpadded = hashtags.explode_hashtags_created(recs(spark, values[:1]), hour_format="H").collect()
    assert unpadded[0].hour == "9"


def test_us_filter_drops_null_place_and_null_code(spark):
    values = [status(["a"], place="US", name="u1"), status(["a"], place=None), status(["a"], place="GB"),
              json.dumps({"place": {"country_code": None}, "user": {"name": "x"}})]
    us = hashtags.us_statuses(recs(spark, values))
    assert us.count() == 1
    ing = hashtags.ingest_records(us).collect()[0]
    assert ing.key == "u1" and ing.value == values[0] and ing.timestamp_ms == 1704099900000


def test_keyword_hits_whole_tokens_case_insensitive(spark):
    docs = spark.createDataFrame([(1, "Big DATA and ai."), (2, "bigdata dataset"), (3, "machine-learning course")],
                                 "doc_id long, text string")
    got = {r.doc_id: r.n_hits for r in hashtags.keyword_hits(docs, ("big", "data", "ai", "machine",
                                                                  "learning", "course")).collect()}
    assert got == {1: 3, 3: 3}


def test_quality_metrics_observed_in_the_same_pass(spark):
    values = [status(["a"]), status([]), "{broken", status(drop=("entities",))]
    decoded, obs = hashtags.with_quality_metrics(recs(spark, values))
    counts = hashtags.decoded_hourly_counts(decoded)
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
    assert [r.hashtag for r in counts.collect()] == ["a"]
    assert obs.get == {"records": 4, "unparseable": 1, "without_hashtags": 2}


def test_reasons_not_to_count(spark):
    from larkspur.functions import statuses
    late = json.dumps({"created_at": "Fri Jan 01 00:00:00 +0000 2100", "entities": {"hashtags": [{"text": "a"}]}})
    values = [status(["a"]), status([None]), status([]), status(drop=("entities",)), status(drop=("created_at",)), late,
              "{broken", "[1]", '"text"', "", None, "{}", json.dumps({"created_at": 5, "entities": "x"})]
    frame = recs(spark, values)
    got = {r["offset"]: (r["st_reason"], r["st_tags"]) for r in statuses.decoded(frame).collect()}
    assert [got[i][0] for i in range(len(values))] == [
        "counted", "counted", "untagged", "untagged", "undated", "future", *["malformed"] * 6, "undated"]
    assert got[0][1] == ["a"] and got[1][1] == [None] and got[2][1] == []
    plan = hashtags.reasons(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
    assert {r["reason"]: r["n"] for r in hashtags.reasons(frame).collect()} == {
        "counted": 2, "untagged": 2, "undated": 2, "future": 1, "malformed": 6}


def test_records_csv_scan(spark, tmp_path):
    from larkspur.sources import delimited
    p = tmp_path / "batch.txt"
    p.write_text('u1;{"entities":{"hashtags":[{"text":"spark","indices":[0,6]}]}};t;0;0;1704067200;0\n')
    df = delimited.read_records_csv(spark, str(p))
    assert [r.hashtag for r in hashtags.explode_hashtags(df, keep=()).collect()] == ["spark"]


def test_tracked_statuses(spark):
    vals = [json.dumps({"text": "Learning Spark today"}), json.dumps({"text": "nothing here"}),
            json.dumps({"text": None}), "{bad"]
    got = hashtags.tracked_statuses(recs(spark, vals), ("big", "data", "ai", "machine", "learning", "course"))
    assert [r.offset for r in got.collect()] == [0]


def test_ingest_parses_each_status_once(spark, sf_dir):
    from larkspur.operators import hashtags
    from larkspur.plans.queries_hashtags import records
    plan = hashtags.ingest_records(records(spark, sf_dir), country="US")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_joinback_counts_parse_distinct_pairs(spark, sf_dir):
    import __spark_entry__ as ent
    plan = ent.queries()["city_value_joinback"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    counts = plan[plan.index("Aggregate [cityid"):]
    below = counts[counts.index("\n", counts.rindex("Aggregate [cityid")):]
    assert "RLIKE" in counts and "RLIKE" not in below        # the rules see distinct pairs, not the scan
