"""Hotel booking lines: comma text, 22 values per line.

Only positions 11 (adults), 18 (continent), 19 (country) and 20 (market)
carry meaning.  The fixture builds one line per ``lineitem`` row joined to
its supplier's nation and region and to its part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

N_VALUES = 22
ADULTS, CONTINENT, COUNTRY, MARKET = 11, 18, 19, 20


def booking_lines(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame,
                  region: DataFrame, part: DataFrame) -> DataFrame:
    """``value`` text lines (fixture rule).

    [0] ship date, [11] ``l_linenumber`` (" 2" when line 2 and
    ``l_partkey % 11 = 0``), [18] region name, [19] nation name, [20] part
    brand (empty when ``l_orderkey % 19 = 0``), [21] ``l_partkey % 100``;
    ``l_orderkey % 17 = 0``: all three keys empty; ``% 13 = 0``: 21 values;
    ``% 29 = 0``: 23 values.  Dimension joins are left to the planner, which
    broadcasts a side only when its size statistics are under the threshold.
    """
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    j = (li.join(supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
         .join(nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "n_regionkey"), "s_nationkey")
         .join(region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), "n_regionkey")
         .join(part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey"))
    ok = F.col("l_orderkey")
    s = lambda c: c.cast("string")
    blank_all = ok % 17 == 0
    adults = F.when((F.col("l_linenumber") == 2) & (F.col("l_partkey") % 11 == 0), F.lit(" 2")) \
        .otherwise(s(F.col("l_linenumber")))
    vals = [F.date_format("l_shipdate", "yyyy-MM-dd"), s(F.col("l_suppkey") % 3), F.lit("3"),
            s(F.col("l_orderkey") % 200), F.lit(""), F.lit(""), s(F.col("l_orderkey") % 7),
            F.lit("0"), F.lit("1"), F.lit("9"), F.date_format("l_shipdate", "yyyy-MM-dd"),
            adults, F.lit("0"), F.lit("1"), F.lit("8250"), F.lit("1"), F.lit("0"), F.lit("1"),
            F.when(blank_all, F.lit("")).otherwise(F.col("r_name")),
            F.when(blank_all, F.lit("")).otherwise(F.col("n_name")),
            F.when(blank_all | (ok % 19 == 0), F.lit("")).otherwise(F.col("p_brand")),
            s(F.col("l_partkey") % 100)]
    line = F.concat_ws(",", *vals)
    line = (F.when(ok % 13 == 0, F.regexp_replace(line, ",[^,]*$", ""))
            .when(ok % 29 == 0, F.concat(line, F.lit(",x")))
            .otherwise(line))
    return j.select(line.alias("value"))


def parse_couples(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Keep lines of exactly 22 values whose adults value is exactly "2"; ``keep`` names columns to carry."""
    v = F.split(F.col("value"), ",", -1)
    return (lines.select(*keep, v.alias("v"))
            .where((F.size("v") == N_VALUES) & (F.get(F.col("v"), ADULTS) == "2"))
            .select(*keep, F.get(F.col("v"), CONTINENT).alias("continent"), F.get(F.col("v"), COUNTRY).alias("country"),
                    F.get(F.col("v"), MARKET).alias("market")))
