"""Completeness, freshness, failures, coverage, gates and contract rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def completeness(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, filled, total, share) in one pass; the shares of an empty table are null."""
    one = df.agg(F.count(F.lit(1)).alias("total"), *[F.count(f).alias(f) for f in fields])
    return one.unpivot("total", fields, "field", "filled").select("field", "filled", "total", F.round(F.try_divide("filled", "total"), 6).alias("share"))


def freshness(df: DataFrame, source: str, ts: str, as_of: str) -> DataFrame:
    """The latest observation of each source and its age in days."""
    return df.groupBy(F.col(source).alias("source")).agg(F.max(ts).alias("latest")).select("source", "latest", F.datediff(F.lit(as_of).cast("date"), F.to_date("latest")).cast("long").alias("age_days"))


def source_gaps(df: DataFrame, source: str, ts: str, least_hours: int, as_of: str) -> DataFrame:
    """(source, gap_from, gap_to, hours, open): where a source was silent for at least least_hours between two hours that have observations, or up to as_of.

    Observations become hours by partial aggregation first, so a hot source's window holds its hours, not its rows.  Null times are no observations;
    a null source is one as well.
    """
    hours = df.where(F.col(ts).isNotNull()).groupBy(F.col(source).alias("source"), F.date_trunc("hour", ts).alias("gap_from")).agg(F.lit(1).alias("one"))
    after = F.lead("gap_from").over(Window.partitionBy("source").orderBy("gap_from"))
    found = hours.select("source", "gap_from", F.coalesce(after, F.lit(as_of).cast("timestamp")).alias("gap_to"), after.isNull().alias("open"))
    length = F.floor((F.unix_timestamp("gap_to") - F.unix_timestamp("gap_from")) / 3600).cast("long")
    return found.select("source", "gap_from", "gap_to", length.alias("hours"), "open").where(F.col("hours") >= least_hours)


def counts_by(df: DataFrame, reason: Column) -> DataFrame:
    return df.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def violations(df: DataFrame, id_col: str, rules: dict[str, Column]) -> DataFrame:
    """(id, rule) of each rule that a row breaks; a rule that is null is broken."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]), lambda x: x.isNotNull())
    return df.select(F.col(id_col).alias("id"), F.explode(broken).alias("rule"))


def validation_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, checked, broken) for every rule, also those that nothing breaks."""
    one = df.agg(F.count(F.lit(1)).alias("checked"), *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(n) for n, ok in rules.items()])
    return one.unpivot("checked", list(rules), "rule", "broken").select("rule", "checked", "broken")


def gate(df: DataFrame, group: str, ok: Column, least: float) -> DataFrame:
    """Whether the share of good rows reaches `least`, by group."""
    n, good = F.count(F.lit(1)), F.count_if(ok)
    return df.groupBy(F.col(group).alias("grp")).agg(n.alias("n"), good.alias("n_ok"), F.round(good / n, 6).alias("rate"), (good >= least * n).alias("passed"))


def quality(df: DataFrame, said: Column, true: Column) -> DataFrame:
    """True and false positives and negatives, precision and recall."""
    tp, fp, fn = F.count_if(said & true), F.count_if(said & ~true), F.count_if(~said & true)
    return df.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn")).select("tp", "fp", "fn", F.round(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), 6).alias("precision"), F.round(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")), 6).alias("recall"))
