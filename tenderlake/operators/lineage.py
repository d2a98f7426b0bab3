"""Amendments, predecessors, chains, traces and differences between versions."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenderlake.session import Scratch


def amendments(df: DataFrame, parent: str, order: list[str], record: str) -> DataFrame:
    """Each record with its number within its parent, the parent's first and latest record."""
    w = Window.partitionBy(parent).orderBy(*order)
    whole = Window.partitionBy(parent)
    key = F.struct(*order)
    return df.select(F.col(parent).alias("parent"), F.col(record).alias("record"), F.row_number().over(w).cast("long").alias("version"), F.min_by(record, key).over(whole).alias("original"), F.max_by(record, key).over(whole).alias("latest"))


def scored_links(records: DataFrame, blocks: list[str], record: str, date: str, signals: dict[str, tuple[int, Column]], least: int, within_days: int) -> DataFrame:
    """(record, predecessor, score, signals): earlier records that agree in any of the blocking keys, with enough weighted signals.

    A signal is (weight, condition over `a_` columns of the record and `b_` columns of the candidate).  Records meet in
    bins of within_days days, each candidate in its own and the next one, so a key's records are not all compared.
    A pair that agrees in several keys is found under the first of them only.
    """
    day = F.datediff(F.col(date).cast("date"), F.lit("1970-01-01").cast("date"))
    bin_ = F.floor(day / within_days).cast("long")
    a = records.select(*[F.col(c).alias(f"a_{c}") for c in records.columns], bin_.alias("bin"))
    b = records.select(*[F.col(c).alias(f"b_{c}") for c in records.columns], F.explode(F.array(bin_, bin_ + 1)).alias("bin"))
    days = F.datediff(f"a_{date}", f"b_{date}")
    score = sum((F.when(ok, weight).otherwise(0) for weight, ok in signals.values()), F.lit(0))
    told = F.array_join(F.filter(F.array(*[F.when(ok, F.lit(n)) for n, (_, ok) in signals.items()]), lambda x: x.isNotNull()), ",")
    found = []
    for i, block in enumerate(blocks):
        met = a.join(b, (F.col(f"a_{block}") == F.col(f"b_{block}")) & (a["bin"] == b["bin"])).where((days > 0) & (days <= within_days))
        for earlier in blocks[:i]:
            met = met.where(~F.coalesce(F.col(f"a_{earlier}") == F.col(f"b_{earlier}"), F.lit(False)))
        found.append(met.select(F.col(f"a_{record}").alias("record"), F.col(f"b_{record}").alias("predecessor"), score.cast("long").alias("score"), told.alias("signals")).where(F.col("score") >= least))
    return functools.reduce(DataFrame.unionByName, found)


def chains(edges: DataFrame, orphan: str | None = None) -> DataFrame:
    """(node, root, depth) of (node, parent), parent null at a root: parents are doubled, over tables in the shared folder, until all rows have reached a root.

    A row whose line of parents ends outside the nodes stays: the last node of that line is its root.  `orphan` names a column that
    tells these rows apart.  A cycle is an error.
    """
    scratch = Scratch(edges.sparkSession, "chains")
    known = edges.where("node IS NOT NULL")
    inside = known.select(F.col("node").alias("parent")).distinct().withColumn("inside", F.lit(True))
    named = known.join(inside, "parent", "left")  # a null parent meets none
    up = F.col("inside").isNotNull()
    first = scratch.save(named.select("node", F.when(up, F.col("parent")).otherwise(F.col("node")).alias("anc"), F.when(up, 1).otherwise(0).cast("long").alias("depth"), (~up & F.col("parent").isNotNull()).alias("lost")))
    done, climbing = first.where("depth = 0"), first.where("depth > 0")
    n, reach = first.count(), 1
    while not climbing.isEmpty():  # each of these rows is `reach` steps above its node
        if reach >= n:
            raise ValueError("the parents form a cycle")
        up = done.withColumn("ended", F.lit(True)).unionByName(climbing.withColumn("ended", F.lit(False)))
        up = up.select(F.col("node").alias("anc"), F.col("anc").alias("next"), F.col("depth").alias("more"), "ended", F.col("lost").alias("above"))
        climbed = scratch.save(climbing.join(up, "anc").select("node", F.col("next").alias("anc"), (F.col("depth") + F.col("more")).alias("depth"), F.col("above").alias("lost"), "ended"))
        done = done.unionByName(climbed.where("ended").drop("ended"))
        climbing, reach = climbed.where("NOT ended").drop("ended"), 2 * reach
    return done.select("node", F.col("anc").alias("root"), "depth", *([F.col("lost").alias(orphan)] if orphan else []))


def closure(edges: DataFrame, digits: int = 9) -> DataFrame:
    """(node, ancestor, confidence, hops, known) of (node, parent, confidence): every record that a record descends from, over several predecessors.

    confidence is the highest product along any way, hops the fewest edges of a way of that confidence.  Semi-naive: each round joins only what
    the last one found or bettered with the edges, over stored tables, until nothing is new; rounds are as many as the longest best way has
    edges.  Confidences are within 0 to 1, so a cycle never betters itself: its records are ancestors of themselves, which shows it.
    Ancestors that are no node of an edge's own side stay, with known false.  Products are rounded to `digits`.
    Defined cases: edges with a null end or confidence are left out; of repeated edges the most confident counts; an empty table gives no rows.
    """
    scratch = Scratch(edges.sparkSession, "closure")
    one = edges.where("node IS NOT NULL AND parent IS NOT NULL AND confidence IS NOT NULL").groupBy("node", "parent").agg(F.round(F.max("confidence").cast("double"), digits).alias("confidence"))
    one = scratch.save(one, "edges")
    best = fresh = one.select("node", F.col("parent").alias("ancestor"), "confidence", F.lit(1).cast("long").alias("hops"))
    up = one.select(F.col("node").alias("ancestor"), F.col("parent").alias("above"), F.col("confidence").alias("c"))
    rank = F.struct("confidence", (-F.col("hops")).alias("near"))
    while True:
        reached = fresh.join(up, "ancestor").select("node", F.col("above").alias("ancestor"), F.round(F.col("confidence") * F.col("c"), digits).alias("confidence"), (F.col("hops") + 1).alias("hops"))
        top = reached.groupBy("node", "ancestor").agg(F.max(rank).alias("new"))
        old = best.select("node", "ancestor", rank.alias("old"))
        better = top.join(old, ["node", "ancestor"], "left").where(F.col("old").isNull() | (F.col("new") > F.col("old")))
        fresh = scratch.save(better.select("node", "ancestor", F.col("new.confidence").alias("confidence"), (-F.col("new.near")).alias("hops")), "fresh")
        if fresh.isEmpty():
            break
        best = scratch.save(best.unionByName(fresh).groupBy("node", "ancestor").agg(F.max(rank).alias("new")).select("node", "ancestor", F.col("new.confidence").alias("confidence"), (-F.col("new.near")).alias("hops")), "best")
    nodes = one.select(F.col("node").alias("ancestor")).distinct().withColumn("known", F.lit(True))
    return best.join(nodes, "ancestor", "left").select("node", "ancestor", "confidence", "hops", F.coalesce("known", F.lit(False)).alias("known"))


def no_match_trace(targets: DataFrame, key: str, records: DataFrame, other: str, searched: dict[str, str]) -> DataFrame:
    """The targets without a record, each with what was searched; it proves no more than that."""
    missing = targets.join(records, F.col(key) == F.col(other), "left_anti")
    return missing.select(F.col(key).alias("target"), *[F.lit(v).alias(k) for k, v in searched.items()], F.lit("no match in searched sources").alias("result"))


def version_changes(df: DataFrame, parent: str, order: list[str], record: str, fields: dict[str, Column]) -> DataFrame:
    """(record, predecessor, field, old, new): what differs from the version before, nulls compared as values."""
    w = Window.partitionBy(parent).orderBy(*order)
    pairs = df.select(F.col(record).alias("record"), F.lag(record).over(w).alias("predecessor"), *[F.struct(F.lit(n).alias("field"), F.lag(c).over(w).alias("old"), c.alias("new")).alias(n) for n, c in fields.items()])
    one = pairs.where("predecessor IS NOT NULL").select("record", "predecessor", F.explode(F.array(*fields)).alias("f")).select("record", "predecessor", "f.*")
    return one.where(~F.col("old").eqNullSafe(F.col("new")))


def field_changes(records: DataFrame, parent: str, order: list[str], record: str, date: str, amount: str, scope: DataFrame) -> DataFrame:
    """(record, predecessor, days_later, amount_change, scope_added, scope_removed) against the version before; scope is (record, item).

    Items of either side that the other lacks, in order, joined by commas.  A missing date or amount of either makes the change unknown; a record without
    items has an empty scope; first versions have no row.
    """
    w = Window.partitionBy(parent).orderBy(*order)
    pairs = records.select(F.col(record).alias("record"), F.lag(record).over(w).alias("predecessor"), F.datediff(date, F.lag(date).over(w)).cast("long").alias("days_later"), (F.col(amount) - F.lag(amount).over(w)).cast("double").alias("amount_change")).where("predecessor IS NOT NULL")
    items = scope.groupBy("record").agg(F.collect_set("item").alias("items"))
    none = F.array().cast(items.schema["items"].dataType)
    met = pairs.join(items, "record", "left").join(items.select(F.col("record").alias("predecessor"), F.col("items").alias("old")), "predecessor", "left")
    met = met.withColumns({"items": F.coalesce("items", none), "old": F.coalesce("old", none)})
    told = lambda a, b: F.array_join(F.sort_array(F.array_except(a, b)).cast("array<string>"), ",")
    return met.select("record", "predecessor", "days_later", "amount_change", told("items", "old").alias("scope_added"), told("old", "items").alias("scope_removed"))
