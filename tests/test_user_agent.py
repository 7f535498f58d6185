import pytest

from larkspur.functions import user_agent
from larkspur.sources.bids import EXPECTED_UA, USER_AGENTS


@pytest.fixture(scope="module")
def uas(spark):
    return spark.createDataFrame([(i, u) for i, u in enumerate(USER_AGENTS)], "i int, useragent string")


def test_rules_match_expected_values(uas):
    got = {r.i: (r.device, r.os, r.browser) for r in user_agent.enrich(uas).collect()}
    assert [got[i] for i in range(len(USER_AGENTS))] == EXPECTED_UA


def test_sql_table_function_matches_columns(spark, uas):
    fn = user_agent.register_sql_function(spark)
    uas.createOrReplaceTempView("t_uas")
    got = {r.i: (r.device, r.os, r.browser)
           for r in spark.sql(f"SELECT t.i, p.* FROM t_uas t, LATERAL {fn}(t.useragent) p").collect()}
    assert [got[i] for i in range(len(USER_AGENTS))] == EXPECTED_UA


@pytest.mark.parametrize("bad", [None, "", "null"])
def test_unknown_input_gives_unknown_everywhere(spark, bad):
    df = spark.createDataFrame([(bad,)], "useragent string")
    r = user_agent.enrich(df).collect()[0]
    assert (r.device, r.os, r.browser) == ("Unknown", "Unknown", "Unknown")


def test_enrichment_stays_in_codegen(uas):
    plan = user_agent.enrich(uas)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "*(" in plan  # whole-stage codegen marker


def test_ios_precedes_mac(spark):
    df = spark.createDataFrame([("Mozilla/5.0 (iPhone; CPU iPhone OS 9_3 like Mac OS X) Mobile/13E233",)],
                               "useragent string")
    r = user_agent.enrich(df).select("device", "os").collect()[0]
    assert (r.device, r.os) == ("Mobile", "iOS 9 (iPhone)")


@pytest.mark.parametrize("call", ["parse_ua()", "parse_ua('a', 'b')"])
def test_table_function_takes_exactly_one_argument(spark, call):
    from pyspark.errors import AnalysisException
    user_agent.register_sql_function(spark)
    with pytest.raises(AnalysisException):
        spark.sql(f"SELECT * FROM {call}").collect()


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60),
                          st.sampled_from(["Android 9", "iPad; CPU OS 12_1", "MSIE x", "Chrome/ Mobile"])),
                min_size=1, max_size=8))
def test_rules_total_on_arbitrary_text(spark, uas):
    df = spark.createDataFrame([(u,) for u in uas], "useragent string")
    for r in user_agent.enrich(df).collect():
        assert r.device and r.os and r.browser
