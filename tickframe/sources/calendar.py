"""The session calendar as a frame (K3): other operators take it as an input, whether it is made here or read from a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sessions(bounds: DataFrame, holidays: DataFrame, early: DataFrame, zone: str = "America/New_York", opens: str = "09:30", closes: str = "16:00", closes_early: str = "13:00", option_minutes: int = 15) -> DataFrame:
    """day, open_at, close_at, option_close_at (instants, by the exchange's wall clock), early and idx of every session.

    bounds: one row, first and last day. holidays and early: frames of day; sessions are the weekdays that are no holiday.
    An early day that is no session adds nothing; repeated and null days count once or not at all. A calendar has a row
    for each day there is, so its days are numbered as one sorted array.
    """
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("day")).where(F.weekday("day") < 5)
    kept = days.join(holidays.select("day").distinct(), "day", "left_anti")
    numbered = kept.agg(F.array_sort(F.collect_list("day")).alias("d")).select(F.posexplode("d").alias("at", "day"))
    j = numbered.join(early.select("day").distinct().withColumn("_early", F.lit(True)), "day", "left")

    def wall(clock: Column) -> Column:
        return F.to_utc_timestamp(F.concat(F.col("day").cast("string"), F.lit(" "), clock).cast("timestamp"), zone)

    early_day = F.coalesce("_early", F.lit(False))
    close = wall(F.when(early_day, closes_early).otherwise(closes))
    return j.select("day", wall(F.lit(opens)).alias("open_at"), close.alias("close_at"), (close + F.make_dt_interval(mins=F.lit(option_minutes))).alias("option_close_at"), early_day.alias("early"), (F.col("at") + 1).cast("long").alias("idx"))
