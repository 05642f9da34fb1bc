"""Date expressions; dates are stored as ISO text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bandstand.functions.text import bounded_year


def life_span_year(begin: Column, first_year: int, last_year: int) -> Column:
    """Year of a life-span start (``2003``, ``2003-05``...), null outside the bounds."""
    year = F.substring(begin, 1, 4)
    parsed = F.when(F.length(begin) >= 4, year.try_cast("int"))
    return bounded_year(parsed, F.lit(first_year), F.lit(last_year))


def release_year(date_text: Column) -> Column:
    """Year of a full or partial ISO date, null for anything unreadable."""
    return F.year(F.try_to_date(date_text))


def years_since(year: Column, as_of_year: int) -> Column:
    return F.lit(as_of_year) - year


def run_date_text(run_date: dt.date | str | None = None) -> Column:
    """The partition text of a run: the given day, else today."""
    if run_date is None:
        return F.date_format(F.current_date(), "yyyy-MM-dd")
    return F.lit(run_date if isinstance(run_date, str) else run_date.isoformat())


def week_start(day: Column) -> Column:
    """ISO text of the Monday of a day's week."""
    return F.date_format(F.date_trunc("week", day), "yyyy-MM-dd")


def periods_back(df: DataFrame, end: Column, weeks_back: int = 52) -> DataFrame:
    """Give each row its seven-day periods, walking back from ``end``, newest first."""
    number = F.explode(F.sequence(F.lit(0), F.lit(weeks_back - 1)))
    return (
        df.withColumn("_end", end.cast("date"))
        .withColumn("period", number)
        .withColumn("_week_end", F.date_format(F.date_sub("_end", F.col("period") * 7), "yyyy-MM-dd"))
        .withColumn("_week_start", F.date_format(F.date_sub("_end", F.col("period") * 7 + 7), "yyyy-MM-dd"))
        .drop("_end")
    )


def week_calendar(spark: SparkSession, run_date: str, weeks_back: int = 52) -> DataFrame:
    return periods_back(spark.range(1).select(), F.lit(run_date), weeks_back)
