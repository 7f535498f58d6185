from larkspur.operators import couples
from larkspur.sources import bookings


def line(adults="2", continent="EU", country="FR", market="PAR", n=22):
    v = ["x"] * n
    if n > 20:
        v[11], v[18], v[19], v[20] = adults, continent, country, market
    return ",".join(v)


def test_filter_and_keys(spark):
    lines = [line(), line(), line(market=""), line(adults="1"), line(adults=" 2"), line(n=21), line(n=23),
             line(continent="", country="", market=""), "date,site,header", line(country="DE")]
    df = spark.createDataFrame([(l,) for l in lines], "value string")
    got = {r.market_key: r.cnt for r in couples.market_counts(bookings.parse_couples(df)).collect()}
    assert got == {"EU#FR#PAR": 2, "EU#FR#": 1, "EU#DE#PAR": 1}


def test_trailing_empty_values_count_as_values(spark):
    v = ["x"] * 22
    v[11], v[18], v[19], v[20], v[21] = "2", "AS", "JP", "TYO", ""
    df = spark.createDataFrame([(",".join(v),)], "value string")
    assert bookings.parse_couples(df).count() == 1


def test_top_and_bottom_with_key_tiebreak(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 5), ("c", 1), ("d", 9), ("e", 1)], "market_key string, cnt long")
    assert [r.market_key for r in couples.top_markets(counts).collect()] == ["d", "a", "b"]
    assert [r.market_key for r in couples.top_markets(counts, ascending=True).collect()] == ["c", "e", "a"]
    assert [r.line for r in couples.result_lines(couples.top_markets(counts)).collect()] == ["d : 9", "a : 5", "b : 5"]


def test_partials_merge_to_the_same_counts(spark):
    df = spark.createDataFrame([("p1", "A#B#C,2"), ("p2", "A#B#C,3"), ("p2", "X#Y#,1"), ("p3", "bad")],
                               "split string, value string").select("value")
    got = {r.market_key: r.cnt for r in couples.merge_partials(df).collect()}
    assert got == {"A#B#C": 5, "X#Y#": 1}


from hypothesis import given, settings, strategies as st  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["EU", "AS", ""]), st.sampled_from(["FR", ""]), st.sampled_from(["P", ""]),
                          st.sampled_from(["2", "1"]), st.integers(min_value=0, max_value=3)), min_size=1, max_size=12))
def test_partials_merge_equals_direct_counts(spark, rows):
    lines = [(line(adults=a, continent=c, country=k, market=m), f"split{s}") for c, k, m, a, s in rows]
    df = spark.createDataFrame(lines, "value string, split string")
    direct = {r.market_key: r.cnt for r in couples.market_counts(bookings.parse_couples(df.select("value"))).collect()}

    def couples_of(d):
        v = F.split(F.col("value"), ",", -1)
        return (d.select("split", v.alias("v")).where((F.size("v") == 22) & (F.get(F.col("v"), 11) == "2"))
                .select("split", F.get(F.col("v"), 18).alias("continent"), F.get(F.col("v"), 19).alias("country"),
                        F.get(F.col("v"), 20).alias("market")))

    merged = {r.market_key: r.cnt for r in couples.merge_partials(couples.partial_counts(df, couples_of)).collect()}
    assert merged == direct
