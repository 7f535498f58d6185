from hypothesis import given, settings, strategies as st

from larkspur.functions import codec
from larkspur.session import scratch_path
from larkspur.sources import delimited
from pyspark.sql import types as T

tags = st.text(alphabet=st.sampled_from(list("ab;#é _\n\t\"\\\r")), min_size=1, max_size=8)


def test_encode_keys_and_values(spark):
    df = spark.createDataFrame([("2024-01-01", "09", "spark", 4)], "date string, hour string, hashtag string, cnt long")
    r = codec.encode(df).collect()[0]
    assert (r.key, r.value) == ("2024-01-01;09", "2024-01-01;09;spark;4")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(tags, st.integers(min_value=0, max_value=10**12)), min_size=1, max_size=5))
def test_round_trip_keeps_hashtags_with_delimiters(spark, rows):
    df = spark.createDataFrame([("2024-01-01", "09", t, c) for t, c in rows],
                               "date string, hour string, hashtag string, cnt long")
    back = codec.decode_columns(codec.encode(df)).collect()
    assert sorted((r.hashtag, r.cnt) for r in back) == sorted(rows)


def test_rollup_sums_within_one_batch(spark):
    recs = spark.createDataFrame([("k", v) for v in ["d;h;a;2", "d;h;a;1", "d;h;a;3", "d;h;b;4", "d;h;b;4", "junk"]],
                                 "key string, value string")
    got = {r.stat_key: r.cnt for r in codec.rollup(codec.decode(recs)).collect()}
    assert got == {"d;h;a": 6, "d;h;b": 8}


def test_decode_columns_tolerates_short_keys(spark):
    recs = spark.createDataFrame([("k", "a;5"), ("k", "d;h;t;2")], "key string, value string")
    got = sorted((tuple(r) for r in codec.decode_columns(recs).collect()), key=str)
    assert got == sorted([("a", None, None, 5), ("d", "h", "t", 2)], key=str)


odd = st.text(alphabet=st.sampled_from(list("ab;\n\t\"\\\r,'nrt0\0N é")), max_size=8)


@settings(max_examples=8, deadline=None)
@given(st.lists(odd, min_size=1, max_size=6))
def test_text_files_lose_no_character(spark, values):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType()), T.StructField("n", T.IntegerType())])
    rows = [(v, None if i % 3 == 0 else v[::-1], i) for i, v in enumerate([*values, "\\N", ""])]
    path = scratch_path(spark, "t-tsv-odd")
    delimited.write_tsv(spark.createDataFrame(rows, schema), path)
    assert sorted(tuple(r) for r in delimited.read_tsv(spark, path, schema, escapes=True).collect() if r.b is not None) == \
        sorted(r for r in rows if r[1] is not None)
    assert spark.read.text(path).count() == len(rows)
    stats = [("2024-01-01", "09", v, i) for i, v in enumerate(values) if v]
    path = scratch_path(spark, "t-stats-odd")
    delimited.write_stats_csv(spark.createDataFrame(stats, "date string, hour string, hashtag string, cnt long"), path)
    assert sorted(tuple(r) for r in delimited.read_stats_csv(spark, path).collect()) == sorted(stats)
