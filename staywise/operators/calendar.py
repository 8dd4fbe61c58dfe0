"""Calendar dimensions and date hierarchies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _spine(bounds: DataFrame, start: Column, end: Column, name: str) -> DataFrame:
    return bounds.select(F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias(name))


def date_attributes(days: DataFrame, d: str = "date_key") -> DataFrame:
    """The 14 calendar attributes of the gold date dimension."""
    c = F.col(d)
    return days.select(
        c.alias("date_key"),
        F.year(c).alias("year"), F.month(c).alias("month"), F.dayofmonth(c).alias("day"),
        F.quarter(c).alias("quarter"),
        F.date_format(c, "MMMM").alias("month_name"), F.date_format(c, "MMM").alias("month_short"),
        F.date_format(c, "EEEE").alias("day_name"), F.date_format(c, "EEE").alias("day_short"),
        F.weekofyear(c).alias("week_of_year"), F.dayofweek(c).alias("day_of_week"),
        F.dayofyear(c).alias("day_of_year"),
        F.dayofweek(c).isin(1, 7).alias("is_weekend"),
        F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string")).alias("year_quarter"),
        F.date_format(c, "yyyy-MM").alias("year_month"),
    )


def dim_date(spark: SparkSession, start: str = "2020-01-01", end: str = "2026-12-31") -> DataFrame:
    """Fixed day spine [start, end] with calendar attributes."""
    b = spark.range(1).select(F.to_date(F.lit(start)).alias("s"), F.to_date(F.lit(end)).alias("e"))
    return date_attributes(_spine(b, F.col("s"), F.col("e"), "date_key"))


def year_bounds(df: DataFrame, date_col: str) -> DataFrame:
    """One row: 1 Jan of the first year and 31 Dec of the last year present."""
    return df.agg(F.min(F.year(date_col)).alias("y0"), F.max(F.year(date_col)).alias("y1")) \
        .where(F.col("y0").isNotNull()) \
        .select(F.make_date(F.col("y0"), F.lit(1), F.lit(1)).alias("s"),
                F.make_date(F.col("y1"), F.lit(12), F.lit(31)).alias("e"))


def dim_date_for(df: DataFrame, date_col: str = "booking_date") -> DataFrame:
    """The gold date dimension spanning the whole years present in ``df``."""
    return date_attributes(_spine(year_bounds(df, date_col), F.col("s"), F.col("e"), "date_key"))


def data_calendar(df: DataFrame, ts_col: str) -> DataFrame:
    """BI-style local date table: every day of the years in ``ts_col`` with
    Year, MonthNo, Month, QuarterNo, Quarter ('Qtr n') and Day."""
    days = _spine(year_bounds(df, ts_col), F.col("s"), F.col("e"), "Date")
    m = F.month("Date")
    q = F.floor((m + 2) / 3).cast("int")
    return days.select(
        F.col("Date"), F.year("Date").alias("Year"), m.alias("MonthNo"),
        F.date_format("Date", "MMMM").alias("Month"), q.alias("QuarterNo"),
        F.concat(F.lit("Qtr "), q.cast("string")).alias("Quarter"), F.dayofmonth("Date").alias("Day"))


def date_part_join(df: DataFrame, calendar: DataFrame, ts_col: str) -> DataFrame:
    """Attach calendar attributes to a timestamp column by its date part.
    Pass a written calendar: Spark then knows its size and broadcasts it only
    below its threshold (a stray far-future date widens the range)."""
    return df.join(calendar, F.to_date(F.col(ts_col)) == calendar["Date"], "left")


# Days of a calendar that may travel as one array: over 500 years.
MAX_DAYS = 200_000


def calendar_over(df: DataFrame, cols) -> DataFrame:
    """:func:`data_calendar` over the years of several date columns, found in
    one pass."""
    ends = df.agg(F.least(*[F.min(F.to_date(c)) for c in cols]).alias("a") if len(cols) > 1
                  else F.min(F.to_date(cols[0])).alias("a"),
                  F.greatest(*[F.max(F.to_date(c)) for c in cols]).alias("b") if len(cols) > 1
                  else F.max(F.to_date(cols[0])).alias("b"))
    return data_calendar(ends.select(F.explode(F.array("a", "b")).alias("d")), "d")


def date_roles(df: DataFrame, calendar: DataFrame, roles, attrs=("Year", "QuarterNo", "MonthNo", "Day"),
               day: str = "Date") -> DataFrame:
    """Calendar attributes for many date columns, without a join for each:
    ``<column>_<attr>`` for every column of ``roles``.

    The calendar is read once, as a scalar subquery that holds its days in
    order; a date finds its day by its distance from the first, so rows are
    never shuffled and a hot day or a NULL costs nothing.  Dates outside the
    calendar, and NULLs, get NULLs.  A calendar with gaps or repeated days, or
    of more than ``MAX_DAYS`` days, is refused: beyond that join by
    :func:`date_part_join`.
    """
    held = calendar.where(F.col(day).isNotNull()).limit(MAX_DAYS + 1).agg(
        F.array_sort(F.collect_list(F.struct(F.col(day).alias("_day"), *attrs))).alias("days"))
    first, last = F.col("days")[0]["_day"], F.element_at("days", -1)["_day"]
    gapless = (F.size("days") <= MAX_DAYS) & (F.size("days") == F.datediff(last, first) + 1) & (
        F.size(F.array_distinct("days._day")) == F.size("days"))
    days = held.select(
        F.when((F.size("days") == 0) | gapless, F.col("days"))
        .otherwise(F.raise_error(F.lit("the calendar has gaps, repeated days or too many of them")))).scalar()

    def found(role: str):
        at = F.datediff(F.to_date(F.col(role)), F.get(days, F.lit(0)).getField("_day"))
        # a negative place is NULL to get(), as is one beyond the end
        return F.get(days, at)

    return df.select("*", *[found(r).getField(a).alias(f"{r}_{a}") for r in roles for a in attrs])


def date_hierarchy_rollup(fact: DataFrame, dates: DataFrame, measure: str = "total_amount_eur") -> DataFrame:
    """Drill Year > Quarter > Month > Day as ROLLUP subtotals, over one row
    per day: the rollup's five-fold expansion sees days, not bookings."""
    return rollup_days(days_of(fact, measure), dates)


def days_of(fact: DataFrame, measure: str = "total_amount_eur") -> DataFrame:
    """Bookings and revenue (an exact decimal) by day."""
    return fact.groupBy("booking_date").agg(F.count("*").alias("n"),
                                            F.sum(F.col(measure).try_cast("decimal(28,2)")).alias("amount"))


def rollup_days(days: DataFrame, dates: DataFrame) -> DataFrame:
    j = date_part_join(days, dates, "booking_date")
    return (j.rollup("Year", "QuarterNo", "MonthNo", "Day")
            .agg(F.sum("n").alias("bookings"), F.sum("amount").cast("double").alias("revenue_eur"),
                 F.grouping_id().cast("int").alias("level")))
