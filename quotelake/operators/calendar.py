"""Calendar tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.functions import compact_date, week_end

# Names of the quarters, and the default span of the calendar.
QUARTER_NAMES = ["First", "Second", "Third", "Fourth"]
CALENDAR_START = "2010-01-01"
CALENDAR_DAYS = 29220
MAX_WINDOW_DAYS = 70


def day_series(spark: SparkSession, start: str = CALENDAR_START, days: int = CALENDAR_DAYS) -> DataFrame:
    """One row per day, in column ``day``."""
    first = F.lit(start).cast("date")
    return spark.range(days).select(F.date_add(first, F.col("id").cast("int")).alias("day"))


def days_spanned(df: DataFrame, date: str) -> DataFrame:
    """One row per day from the least to the greatest ``date``, in column ``day``; none where there is no date."""
    ends = df.agg(F.min(F.to_date(date)).alias("first"), F.max(F.to_date(date)).alias("last"))
    return ends.where(F.col("first").isNotNull()).select(F.explode(F.sequence("first", "last")).alias("day"))


def date_dimension(days: DataFrame, day: str = "day") -> DataFrame:
    """The 29 calendar columns of each distinct date in ``days``."""
    d = F.col("__d")
    month_start = F.trunc(d, "month")
    quarter_start = F.trunc(d, "quarter")
    quarter_end = F.last_day(F.add_months(quarter_start, 2))
    number = F.dayofmonth(d)
    suffix = (
        F.when((number % 100).between(11, 13), "th")
        .when(number % 10 == 1, "st")
        .when(number % 10 == 2, "nd")
        .when(number % 10 == 3, "rd")
        .otherwise("th")
    )
    iso_day = (F.weekday(d) + 1).cast("int")
    iso_week = F.weekofyear(d)
    iso_year = F.extract(F.lit("YEAROFWEEK"), d).cast("int")
    quarter = F.quarter(d)
    names = F.array(*[F.lit(n) for n in QUARTER_NAMES])
    return days.select(F.col(day).cast("date").alias("__d")).where(d.isNotNull()).distinct().select(
        compact_date(d).cast("int").alias("datedim_id"),
        d.alias("actualdate"),
        (F.unix_date(d).cast("bigint") * 86400).alias("epoch"),
        F.concat(number.cast("string"), suffix).alias("daysuffix"),
        F.date_format(d, "EEEE").alias("dayname"),
        iso_day.alias("day_of_week"),
        number.alias("day_of_month"),
        (F.datediff(d, quarter_start) + 1).alias("day_of_quarter"),
        F.dayofyear(d).alias("day_of_year"),
        F.ceil(number / 7).cast("int").alias("week_of_month"),
        iso_week.alias("week_of_year"),
        F.concat(
            iso_year.cast("string"), F.lit("-W"), F.lpad(iso_week.cast("string"), 2, "0"), F.lit("-"), iso_day.cast("string")
        ).alias("week_of_year_iso"),
        F.month(d).alias("month_actual"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_abbreviated"),
        quarter.alias("quarter_actual"),
        F.element_at(names, quarter).alias("quarter_name"),
        iso_year.alias("year_actual"),
        F.date_add(week_end(d), -6).alias("first_day_of_week"),
        week_end(d).alias("last_day_of_week"),
        month_start.alias("first_day_of_month"),
        F.last_day(d).alias("last_day_of_month"),
        quarter_start.alias("first_day_of_quarter"),
        quarter_end.alias("last_day_of_quarter"),
        F.make_date(F.year(d), F.lit(1), F.lit(1)).alias("first_day_of_year"),
        F.make_date(F.year(d), F.lit(12), F.lit(31)).alias("last_day_of_year"),
        F.date_format(d, "MMyyyy").alias("mmyyyy"),
        F.date_format(d, "MMddyyyy").alias("mmddyyyy"),
        (iso_day >= 6).alias("weekend_indr"),
    )


def date_windows(
    spans: DataFrame,
    start: Column | str = "start",
    end: Column | str = "end",
    keep: Sequence[str] = (),
    max_days: int = MAX_WINDOW_DAYS,
) -> DataFrame:
    """Split each [start, end] into the fewest windows of at most ``max_days``.

    Window sizes differ by one day at most, the longer ones first, and the
    windows are contiguous. An empty span (end before start) gives one window
    as it stands.
    """
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    days = (F.datediff(F.col("__end"), F.col("__start")) + 1).cast("int")
    count = F.greatest(F.lit(1), F.ceil(days / max_days).cast("int"))
    base = F.floor(days / F.col("__count")).cast("int")
    longer = (days - F.col("__base") * F.col("__count")).cast("int")
    i = F.col("window_no")
    first = F.date_add(F.col("__start"), (i * F.col("__base") + F.least(i, F.col("__longer"))).cast("int"))
    size = F.col("__base") + F.when(i < F.col("__longer"), 1).otherwise(0)
    return (
        spans.select(*keep, start.cast("date").alias("__start"), end.cast("date").alias("__end"))
        .withColumn("__count", count)
        .withColumn("__base", base)
        .withColumn("__longer", longer)
        .select("*", F.explode(F.sequence(F.lit(0), F.col("__count") - 1)).alias("window_no"))
        .select(
            *keep,
            "window_no",
            first.alias("window_start"),
            F.date_add(first, (size - 1).cast("int")).alias("window_end"),
        )
    )
