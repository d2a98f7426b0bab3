"""Point-in-time joins: what was known of a key strictly before a moment.

Both sides are put into one stream by a union, ordered within (key, date bin), and the last values and running sums of the right
side are carried to the rows of the left; no side is compared with the other.  Bins are made where a key has more than HOT rows: what
earlier bins leave behind comes from one row a bin, so a key with a third of all rows is as many tasks as it has bins.  Without such keys
the rows are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Days of a bin.
BIN_DAYS = 60
#: Rows of one value of the first key column, on both sides, that one task puts in order at most.
HOT = 1_000_000


def as_of(left: DataFrame, right: DataFrame, key: list[str], ts: str, order: list[str], last: dict[str, Column], sums: dict[str, Column], bin_days: int = BIN_DAYS, hot: int = HOT) -> DataFrame:
    """left with `last` of the latest row of right with the same key and an earlier ts, and `sums` over all such rows.

    key and ts are columns of both sides.  Rows of right at one moment are in the order of `order`.  Defined cases: without an earlier row, last is null and
    the sums are 0; a row of left with a null key or ts gets nulls for all of them, as nothing is known of it; such rows of right
    are before nothing; repeated rows of left stay, those of right count each; empty sides give no rows, or rows without history.
    """
    known = F.lit(True)
    for c in [*key, ts]:
        known = known & F.col(c).isNotNull()
    names = [f"_k{i}" for i in range(len(key))]
    keys = [F.col(c).alias(n) for c, n in zip(key, names, strict=True)]
    a = left.where(known).select(F.struct(*left.columns).alias("_row"), *keys, F.col(ts).alias("_ts"), F.lit(0).alias("_side"))
    values = F.struct(*[c.alias(n) for n, c in last.items()], F.lit(1).alias("_any"))
    b = right.where(known).select(*keys, F.col(ts).alias("_ts"), F.lit(1).alias("_side"), F.struct(*order).alias("_order"), values.alias("_last"), *[c.alias(f"_s{i}") for i, c in enumerate(sums.values())])
    day = F.datediff(F.col("_ts").cast("date"), F.lit("1970-01-01").cast("date"))
    # Counted without the rest of the rows; the other key columns only divide a value further.
    sizes = [df.where(known).groupBy(key[0]).agg(F.count(F.lit(1)).alias("_n")) for df in (left, right)]
    binned = not sizes[0].unionByName(sizes[1]).groupBy(key[0]).agg(F.sum("_n").alias("_n")).where(F.col("_n") > hot).isEmpty()
    rows = a.unionByName(b, allowMissingColumns=True).withColumn("_bin", F.floor(day / bin_days).cast("long") if binned else F.lit(0).cast("long"))
    of = [f"_s{i}" for i in range(len(sums))]

    here = Window.partitionBy(*names, *(["_bin"] if binned else [])).orderBy("_ts", "_side", "_order").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({"_here": F.last("_last", ignorenulls=True).over(here), **{f"{s}_here": F.sum(s).over(here) for s in of}}).where("_side = 0").select("_row", *names, "_bin", "_here", *[f"{s}_here" for s in of])
    if not binned:
        found = local.select("_row.*", *[F.col("_here")[n].alias(n) for n in last], *[F.coalesce(f"{s}_here", F.lit(0)).alias(n) for s, n in zip(of, sums, strict=True)])
        return found.unionByName(left.where(~known), allowMissingColumns=True)
    moment = F.when(F.col("_side") == 1, F.struct("_ts", "_order"))
    bins = rows.groupBy(*names, "_bin").agg(F.max_by("_last", moment).alias("_end"), *[F.sum(s).alias(s) for s in of])
    before = Window.partitionBy(*names).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    carried = bins.select(*[F.col(n).alias(f"{n}_b") for n in names], F.col("_bin").alias("_bin_b"), F.last("_end", ignorenulls=True).over(before).alias("_prior"), *[F.sum(s).over(before).alias(f"{s}_prior") for s in of])
    same = F.col("_bin") == F.col("_bin_b")
    for n in names:
        same = same & (F.col(n) == F.col(f"{n}_b"))
    met = local.join(carried, same).withColumn("_found", F.coalesce("_here", "_prior"))
    found = met.select("_row.*", *[F.col("_found")[n].alias(n) for n in last], *[(F.coalesce(f"{s}_here", F.lit(0)) + F.coalesce(f"{s}_prior", F.lit(0))).alias(n) for s, n in zip(of, sums, strict=True)])
    return found.unionByName(left.where(~known), allowMissingColumns=True)
