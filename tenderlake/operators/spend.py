"""Spend history: totals by month, agency and vendor, and concentration over trailing years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.operators.bidding import money

#: Months of a trailing year.
YEAR = 12
#: The totals that are made together.
LEVELS = (("month", "agency", "vendor"), ("month", "agency"), ("month",), ("agency", "vendor"), ("agency",), ())


def month_number(ts: Column) -> Column:
    """Months since year 0, so that ranges of them are ranges of numbers."""
    return (F.year(ts) * 12 + F.month(ts) - 1).cast("int")


def monthly(awards: DataFrame) -> DataFrame:
    """(agency, vendor, month, spent) of awards (agency, vendor, date, amount): the partial sums that all else is made of.  Awards without a date have a null month."""
    return awards.groupBy("agency", "vendor", month_number(F.col("date")).alias("month")).agg(F.sum(money("amount")).alias("spent"), F.count(F.lit(1)).alias("n"))


def rollup(sums: DataFrame) -> DataFrame:
    """(level, month, agency, vendor, spent, n): the monthly sums under each of LEVELS; `level` names what a row is a total of, as nulls are values, too."""
    columns = ["month", "agency", "vendor"]
    found = sums.groupingSets([list(x) for x in LEVELS], *columns).agg(F.sum("spent").cast("double").alias("spent"), F.sum("n").alias("n"), *[F.grouping(c).alias(f"_{c}") for c in columns])
    level = F.concat_ws(",", *[F.when(F.col(f"_{c}") == 0, c) for c in columns])
    return found.select(F.when(level == "", "all").otherwise(level).alias("level"), *columns, "spent", "n")


def trailing_years(sums: DataFrame) -> DataFrame:
    """(agency, month, spent_year, n_vendors, concentration) for each agency and each month from its first to the last of all.

    A monthly sum counts in its month and the eleven after it, so no frame is scanned and a hot agency is spread by vendor and month.
    concentration is the sum of squared shares of the vendors; a year without spend has 0, no vendors and an unknown concentration.
    """
    known = sums.where("month IS NOT NULL")
    last = known.agg(F.max("month").alias("last"))  # one row
    spread = known.join(F.broadcast(last)).select("agency", "vendor", "spent", F.explode(F.sequence("month", F.least(F.col("month") + YEAR - 1, "last"))).alias("month"))
    by_vendor = spread.groupBy("agency", "month", "vendor").agg(F.sum("spent").cast("double").alias("v"))
    found = by_vendor.groupBy("agency", "month").agg(F.sum("v").alias("spent_year"), F.count(F.lit(1)).alias("n_vendors"), F.sum(F.col("v") * F.col("v")).alias("squares"))
    calendar = known.groupBy("agency").agg(F.min("month").alias("first")).join(F.broadcast(last)).select("agency", F.explode(F.sequence("first", "last")).alias("month"))
    met = calendar.alias("c").join(found.alias("f"), F.expr("c.agency <=> f.agency AND c.month = f.month"), "left")
    share = F.try_divide("squares", F.col("spent_year") * F.col("spent_year"))
    return met.select("c.agency", "c.month", F.round(F.coalesce("spent_year", F.lit(0.0)), 2).alias("spent_year"), F.coalesce("n_vendors", F.lit(0)).cast("long").alias("n_vendors"), F.round(share, 6).alias("concentration"))
