"""User-agent parsing as native Spark expressions.

An ordered rule table (first match wins) is rendered two ways from the same
data: as DataFrame ``Column`` expressions (``CASE WHEN rlike ...``, code
generated, no Python on the data path) and as SQL text for the SQL table
function ``parse_ua`` used with ``LATERAL``.  Device follows from the OS
rule.  NULL, "" and "null" give "Unknown" in all three columns.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "Unknown"

# Browser rules in order -> (regex, output; "{1}" = first group).
BROWSER_RULES = [
    (r"Opera Mini", "Opera Mini"),
    (r"OPR/(\d+)", "Opera {1}"),
    (r"Edge?/(\d+)", "Edge {1}"),
    (r"IEMobile/(\d+)", "IE Mobile {1}"),
    (r"MSIE (\d+)", "Internet Explorer {1}"),
    (r"Trident/7.*rv:(\d+)", "Internet Explorer {1}"),
    (r"Firefox/(\d+)", "Firefox {1}"),
    (r"Chrome/\d+\S* Mobile", "Chrome Mobile"),
    (r"Chrome/(\d+)", "Chrome {1}"),
    (r"Version/\S+ Mobile/\S+ Safari", "Mobile Safari"),
    (r"BlackBerry|BB10", "BlackBerry"),
    (r"Version/(\d+)\S* Safari", "Safari {1}"),
    (r"AppleWebKit", "Apple WebKit"),
]

# OS rules in order -> (regex, os output, device).
OS_RULES = [
    (r"Windows Phone OS (\d+)", "Windows Phone {1}", "Mobile"),
    (r"iPad.*OS (\d+)_", "iOS {1} (iPad)", "Tablet"),
    (r"iPhone.*OS (\d+)_", "iOS {1} (iPhone)", "Mobile"),
    (r"Android (\d+).*Mobile", "Android {1}.x", "Mobile"),
    (r"Android (\d+)", "Android {1}.x", "Tablet"),
    (r"Android", "Android", "Mobile"),
    (r"BlackBerry|BB10", "BlackBerry OS", "Mobile"),
    (r"Windows NT 10", "Windows 10", "Computer"),
    (r"Windows NT 6\.3", "Windows 8.1", "Computer"),
    (r"Windows NT 6\.2", "Windows 8", "Computer"),
    (r"Windows NT 6\.1", "Windows 7", "Computer"),
    (r"Windows NT 6\.0", "Windows Vista", "Computer"),
    (r"Windows NT 5\.1", "Windows XP", "Computer"),
    (r"Ubuntu", "Ubuntu", "Computer"),
    (r"Mac OS X", "Mac OS X", "Computer"),
    (r"Linux", "Linux", "Computer"),
]


def _render(ua: Column, pattern: str, template: str) -> Column:
    if "{1}" not in template:
        return F.lit(template)
    pre, post = template.split("{1}", 1)
    return F.concat(F.lit(pre), F.regexp_extract(ua, pattern, 1), F.lit(post))


def _chain(ua: Column, cases: list[tuple[str, Column]]) -> Column:
    known = ua.isNotNull() & (ua != "") & (ua != "null")
    expr = None
    for pattern, value in cases:
        cond = known & ua.rlike(pattern)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(F.lit(UNKNOWN))


def browser(ua: Column) -> Column:
    return _chain(ua, [(p, _render(ua, p, t)) for p, t in BROWSER_RULES])


def os_rule(ua: Column) -> Column:
    """Index of the first matching OS rule (-1: none / unknown input)."""
    return _index(ua, [p for p, _, _ in OS_RULES])


def _index(ua: Column, patterns: list[str]) -> Column:
    known = ua.isNotNull() & (ua != "") & (ua != "null")
    expr = None
    for i, p in enumerate(patterns):
        cond = known & ua.rlike(p)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(-1))


def _os_from_rule(ua: Column, idx: Column) -> Column:
    expr = None
    for i, (p, t, _) in enumerate(OS_RULES):
        v = _render(ua, p, t)
        expr = F.when(idx == i, v) if expr is None else expr.when(idx == i, v)
    return expr.otherwise(F.lit(UNKNOWN))


def _device_from_rule(idx: Column) -> Column:
    devices = F.array(*[F.lit(d) for _, _, d in OS_RULES], F.lit(UNKNOWN))
    return F.element_at(devices, F.when(idx >= 0, idx + 1).otherwise(F.lit(len(OS_RULES) + 1)))


def enrich(df, ua_col: str = "useragent"):
    """Add device, os, browser columns (row preserving, no shuffle).

    The OS rule is matched once per row into a helper column; OS text and
    device both follow from that index, and only the matched rule's group
    is extracted.
    """
    ua = F.col(ua_col)
    tmp = "__os_rule"
    return (df.withColumn(tmp, os_rule(ua))
            .withColumns({"device": _device_from_rule(F.col(tmp)), "os": _os_from_rule(ua, F.col(tmp)),
                          "browser": browser(ua)})
            .drop(tmp))


# ------------------------------------------------------------ SQL rendering

def _sql_lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_render(arg: str, pattern: str, template: str) -> str:
    if "{1}" not in template:
        return _sql_lit(template)
    pre, post = template.split("{1}", 1)
    return f"concat({_sql_lit(pre)}, regexp_extract({arg}, {_sql_lit(pattern)}, 1), {_sql_lit(post)})"


def _sql_chain(arg: str, cases: list[tuple[str, str]]) -> str:
    whens = " ".join(f"WHEN {arg} RLIKE {_sql_lit(p)} THEN {v}" for p, v in cases)
    return (f"CASE WHEN {arg} IS NULL OR {arg} = '' OR {arg} = 'null' THEN '{UNKNOWN}' "
            f"{whens} ELSE '{UNKNOWN}' END")


def sql_columns(arg: str) -> dict[str, str]:
    return {
        "device": _sql_chain(arg, [(p, _sql_lit(d)) for p, _, d in OS_RULES]),
        "os": _sql_chain(arg, [(p, _sql_render(arg, p, t)) for p, t, _ in OS_RULES]),
        "browser": _sql_chain(arg, [(p, _sql_render(arg, p, t)) for p, t in BROWSER_RULES]),
    }


def register_sql_function(spark: SparkSession, name: str = "parse_ua") -> str:
    """Register the SQL table function ``name(ua) -> (device, os, browser)``.

    A SQL (not Python) UDTF: Spark inlines its body into the calling plan,
    so ``FROM t, LATERAL parse_ua(t.useragent)`` is a single projection.
    """
    cols = sql_columns("ua")
    body = ", ".join(f"{expr} AS {c}" for c, expr in cols.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(ua STRING) "
              f"RETURNS TABLE (device STRING, os STRING, browser STRING) RETURN SELECT {body}")
    return name
