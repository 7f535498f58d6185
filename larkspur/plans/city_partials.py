"""Top client per city, kept up to date day by day.

``days`` holds the counts of each (city, user agent) per day; loading a day replaces that day's counts.
``top`` holds the most frequent device, OS and browser of each city.  After a load only cities that the old or the
new counts of the loaded days name are ranked again, from their counts over all days; the
others keep their rows.  A version of ``top`` is a folder that counts once it is complete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.functions import user_agent
from larkspur.operators import bids as ops
from larkspur.plans.archive import _drop, _exists, _fs

DAY_SCHEMA = "cityid string, useragent string, n bigint, bid_date string"
TOP_SCHEMA = "cityid string, kind string, value string, cnt bigint"


class CityPartials:
    """Day counts and top clients below one folder; one writer at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, path: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path) if _exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def days(self) -> DataFrame:
        return self._read(f"{self.root}/days", DAY_SCHEMA)

    def _versions(self) -> list[int]:
        fs, p = _fs(self.spark, f"{self.root}/top")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n) for n in names if _exists(self.spark, f"{self.root}/top/{n}/_SUCCESS"))

    def _version_path(self, n: int) -> str:
        return f"{self.root}/top/{n:010d}"

    def top(self) -> DataFrame:
        """(cityid, kind, value, cnt) of the last load."""
        versions = self._versions()
        return self._read(self._version_path(versions[-1]), TOP_SCHEMA) if versions else self.spark.createDataFrame([], TOP_SCHEMA)

    @staticmethod
    def ranked(counts: DataFrame) -> DataFrame:
        """Rank-1 value per city and attribute from (cityid, useragent, n); a user agent is parsed once per city it is in."""
        combos = user_agent.enrich(counts.groupBy("cityid", "useragent").agg(F.sum("n").alias("n")))
        kinds = F.inline(F.array(*[F.struct(F.lit(a).alias("kind"), F.col(a).alias("value"), F.col("n")) for a in ops.ATTRS]))
        sums = combos.select("cityid", kinds).groupBy("cityid", "kind", "value").agg(F.sum("n").cast("bigint").alias("cnt"))
        rank = F.row_number().over(Window.partitionBy("cityid", "kind").orderBy(F.desc("cnt"), F.asc("value")))
        return sums.withColumn("rank", rank).where(F.col("rank") == 1).drop("rank")

    def load(self, bids: DataFrame) -> int:
        """Replace the counts of the days in ``bids`` (which has bid_date) and bring ``top`` up to date; the cities ranked.

        A load that failed at any point is repeated by loading its days again: until ``top`` is
        written, the names of the cities to rank stay in ``pending``.
        """
        new = (bids.groupBy("bid_date", "cityid", "useragent").agg(F.count(F.lit(1)).alias("n")))
        staged = f"{self.root}/staged"
        new.write.mode("overwrite").parquet(staged)
        new = self.spark.read.schema(DAY_SCHEMA).parquet(staged)
        days = [r["bid_date"] for r in new.select("bid_date").distinct().collect()]          # a row per loaded day
        pending = f"{self.root}/pending"
        old = self.days().where(F.col("bid_date").isin(days))
        (old.select("cityid").unionByName(new.select("cityid")).distinct().write.mode("append").parquet(pending))
        (new.select("cityid", "useragent", "n", "bid_date").hint("rebalance", "bid_date")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bid_date").parquet(f"{self.root}/days"))
        touched = self._read(pending, "cityid string").distinct()
        again = self.ranked(self._only(self.days(), touched, "left_semi"))
        kept = self._only(self.top(), touched, "left_anti")
        versions = self._versions()
        number = (versions[-1] if versions else 0) + 1
        again.unionByName(kept).write.mode("overwrite").parquet(self._version_path(number))
        n = touched.count()
        for done in (pending, staged, *(self._version_path(v) for v in versions[:-1])):
            _drop(self.spark, done)
        return n

    @staticmethod
    def _only(rows: DataFrame, cities: DataFrame, how: str) -> DataFrame:
        """Null city ids are a city of their own."""
        c = cities.withColumnRenamed("cityid", "__city")
        return rows.join(c, F.col("cityid").eqNullSafe(F.col("__city")), how)
