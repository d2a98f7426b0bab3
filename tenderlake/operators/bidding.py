"""Bidder events, awards, vendor profiles, intensity, and predicted bidders and primes.

All work on a table of bids (event, vendor, buyer, commodity, category, amount, date, line).  Where the source
records no award, the lowest amount of an event counts as one, ties by line, vendor and commodity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenderlake.operators.asof import as_of
from tenderlake.session import Scratch

MONEY = "decimal(18,2)"
PARTICIPATION = ("interested", "planholder", "respondent", "bidder", "awardee", "incumbent", "unknown")


def money(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def with_awards(bids: DataFrame) -> DataFrame:
    """The bids with `won`."""
    first = Window.partitionBy("event").orderBy("amount", "line", "vendor", "commodity")
    return bids.withColumn("won", F.row_number().over(first) == 1)


#: Parts of a key's range of values in which the middle is looked for.
BINS = 1024


def exact_median(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """(key, name): the median of each key's values.

    The range of each key is cut into BINS parts, whose counts come from partial aggregation; only the one or two that hold the
    middle are put in order, so that no task holds all values of a hot key.  A null key is one as well.  df is read three times.
    """
    known = df.where(F.col(value).isNotNull()).select(F.col(key).alias("_k"), F.col(value).cast("double").alias("_v"))
    ends = known.groupBy("_k").agg(F.min("_v").alias("low"), F.max("_v").alias("high"), F.count(F.lit(1)).alias("total"))
    same = lambda x, y: F.col(f"{x}._k").eqNullSafe(F.col(f"{y}._k"))
    part = F.coalesce(F.least(F.floor(F.try_divide((F.col("_v") - F.col("low")) * BINS, F.col("high") - F.col("low"))), F.lit(BINS - 1)), F.lit(0)).cast("int")
    placed = known.alias("x").join(ends.alias("y"), same("x", "y")).select("x._k", "_v", part.alias("part"))
    counts = placed.groupBy("_k", "part").agg(F.count(F.lit(1)).alias("n"))
    by_key = Window.partitionBy("_k")
    upto = counts.select("_k", "part", "n", F.sum("n").over(by_key.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), F.sum("n").over(by_key).alias("total"))
    first, second = F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2 + 1)  # the places of the one or two middle values
    held = upto.withColumn("before", F.col("upto") - F.col("n")).where((F.col("upto") >= first) & (F.col("before") < second)).select(F.col("_k").alias("_h"), F.col("part").alias("_p"), "before", first.alias("first"), second.alias("second"))
    few = placed.join(held, F.col("_k").eqNullSafe(F.col("_h")) & (F.col("part") == F.col("_p"))).groupBy("_k", "part", "_v", "before", "first", "second").agg(F.count(F.lit(1)).alias("n"))
    here = F.col("before") + F.sum("n").over(Window.partitionBy("_k", "part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    middle = few.withColumn("upto", here).groupBy("_k").agg(*[F.min(F.when(F.col("upto") >= F.col(at), F.col("_v"))).alias(at) for at in ("first", "second")])
    return middle.select(F.col("_k").alias(key), (F.col("first") * 0.5 + F.col("second") * 0.5).alias(name))


def vendor_profiles(bids: DataFrame) -> DataFrame:
    """bids are with `won`.  Each vendor's bids are summed up by buyer first, so no state holds all buyers; bids without a vendor are one profile, of a null vendor."""
    pairs = bids.groupBy("vendor", "buyer").agg(
        F.count(F.lit(1)).alias("n_bids"),
        F.count_if("won").alias("n_wins"),
        F.sum(F.when(F.col("won"), money("amount"))).alias("won_value"),
        F.min("date").alias("first_seen"),
        F.max("date").alias("last_seen"),
    )
    out = pairs.groupBy("vendor").agg(
        F.sum("n_bids").alias("n_bids"),
        F.sum("n_wins").alias("n_wins"),
        F.sum("won_value").cast("double").alias("won_value"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.count("buyer").alias("n_buyers"),
    )
    held = bids.select("vendor", "category").distinct().groupBy("vendor").agg(F.array_join(F.sort_array(F.collect_set("category")), ",").alias("categories"))
    median = exact_median(bids, "vendor", "amount", "typical_amount")
    same = lambda x: F.col("o.vendor").eqNullSafe(F.col(f"{x}.vendor"))
    met = out.alias("o").join(held.alias("h"), same("h"), "left").join(median.alias("m"), same("m"), "left")
    return met.select("o.vendor", "n_bids", "n_wins", "won_value", "typical_amount", "first_seen", "last_seen", "n_buyers", "categories", (F.col("n_bids") - F.col("n_wins")).alias("n_losses"))


def vendor_activity(bids: DataFrame) -> DataFrame:
    """(vendor, bids_per_year, n_agencies, main_agency, main_share, jurisdictions, win_rate, likely_role) of bids (vendor, buyer, place, date, won).

    Bids are counted by vendor and buyer, and by vendor and place, first, so no state holds all bids of a vendor.  A year is the least span that a frequency
    is told for; of equally frequent agencies the smallest is the main one; a prime has won a fifth of its bids at least, an occasional one any.
    """
    pairs = bids.groupBy("vendor", "buyer").agg(F.count(F.lit(1)).alias("n"), F.count_if("won").alias("wins"), F.min("date").alias("first"), F.max("date").alias("last"))
    most = F.min_by("buyer", F.when(F.col("buyer").isNotNull(), F.struct((-F.col("n")).alias("often"), "buyer")))
    one = pairs.groupBy("vendor").agg(F.sum("n").alias("n"), F.sum("wins").alias("wins"), F.min("first").alias("first"), F.max("last").alias("last"), F.count("buyer").alias("n_agencies"), most.alias("main_agency"), F.max(F.when(F.col("buyer").isNotNull(), F.col("n"))).alias("of_main"))
    places = bids.where("place IS NOT NULL").select("vendor", "place").distinct().groupBy("vendor").agg(F.array_join(F.sort_array(F.collect_list("place")).cast("array<string>"), ",").alias("jurisdictions"))
    met = one.alias("o").join(places.alias("p"), F.col("o.vendor").eqNullSafe(F.col("p.vendor")), "left")
    rate = F.try_divide(F.col("wins").cast("double"), F.col("n"))
    years = F.greatest(F.datediff(F.col("last").cast("date"), F.col("first").cast("date")), F.lit(365)) / 365
    role = F.when(rate >= 0.2, "prime").when(F.col("wins") > 0, "occasional_prime").otherwise("bidder")
    return met.select("o.vendor", F.round(F.col("n") / years, 6).alias("bids_per_year"), "n_agencies", "main_agency", F.round(F.try_divide(F.col("of_main").cast("double"), F.col("n")), 6).alias("main_share"), F.coalesce("jurisdictions", F.lit("")).alias("jurisdictions"), F.round(rate, 6).alias("win_rate"), role.alias("likely_role"))


def incumbents(bids: DataFrame, cutoff: str) -> DataFrame:
    """(buyer, incumbent, awarded): the latest award of each buyer before the cutoff."""
    old = bids.where(F.col("won") & (F.col("date") < F.lit(cutoff).cast("timestamp")))
    latest = F.struct("date", "event")
    return old.groupBy("buyer").agg(F.max_by("vendor", latest).alias("incumbent"), F.max("date").alias("awarded"))


def incumbents_at_events(bids: DataFrame, events: DataFrame) -> DataFrame:
    """events (event, buyer, date, ...) with the vendor and date of the buyer's latest award strictly before, how many there were and their value.  Latest of a day: the largest event."""
    won = bids.where("won").select("buyer", "date", "event", "vendor", money("amount").alias("amount"))
    found = as_of(events, won, ["buyer"], "date", ["event", "vendor"], {"incumbent": F.col("vendor"), "awarded": F.col("date")}, {"n_awards": F.lit(1).cast("long"), "awarded_value": F.col("amount")})
    return found.withColumn("awarded_value", F.col("awarded_value").cast("double"))


def features_at_bids(bids: DataFrame) -> DataFrame:
    """The bids (event, vendor, buyer, date, won, ...) with what was known strictly before their dates: of the vendor, of the vendor with the buyer, and the buyer's incumbent.

    Nothing of the bid's own day or later is used, so these are features of a prediction for that event.
    """
    past = bids.select("vendor", "buyer", "date", "event", "won")
    wins = F.when(F.col("won"), 1).otherwise(0).cast("long")
    one = as_of(bids, past, ["vendor"], "date", ["event"], {"vendor_last": F.col("date")}, {"vendor_bids": F.lit(1).cast("long"), "vendor_wins": wins})
    two = as_of(one, past, ["vendor", "buyer"], "date", ["event"], {"pair_last": F.col("date")}, {"pair_bids": F.lit(1).cast("long"), "pair_wins": wins})
    three = as_of(two, past.where("won"), ["buyer"], "date", ["event", "vendor"], {"incumbent": F.col("vendor")}, {})
    days = lambda c: F.datediff(F.col("date").cast("date"), F.col(c).cast("date")).cast("long")
    return three.withColumns({"vendor_idle_days": days("vendor_last"), "pair_idle_days": days("pair_last"), "is_incumbent": F.col("incumbent") == F.col("vendor")}).drop("vendor_last", "pair_last")


def intensity(bids: DataFrame) -> DataFrame:
    """(event, n_bidders, concentration): concentration is the sum of squared shares of the amounts; null where these sum to 0."""
    one = bids.groupBy("event", "vendor").agg(F.sum(money("amount")).alias("a"))
    share = F.sum("a").over(Window.partitionBy("event"))
    squared = one.select("event", F.pow(F.try_divide(F.col("a").cast("double"), share.cast("double")), 2).alias("s2"))
    return squared.groupBy("event").agg(F.count(F.lit(1)).alias("n_bidders"), F.round(F.sum("s2"), 6).alias("concentration"))


FEATURES = {"same_buyer": 3, "same_buyer_wins": 5, "recent": 2}


def likely_bidders(bids: DataFrame, cutoff: str, top: int = 5, active: Column | None = None) -> DataFrame:
    """(event, vendor, features as contributions, score, place): vendors with a history with the buyer before the cutoff, for events from then on.

    Features come from before the cutoff only.  Each contribution is capped at five times its weight.
    """
    when = F.lit(cutoff).cast("timestamp")
    past = bids.where(F.col("date") < when)
    history = past.groupBy("buyer", "vendor").agg(F.least(F.count(F.lit(1)), F.lit(5)).alias("same_buyer"), F.least(F.count_if("won"), F.lit(5)).alias("same_buyer_wins"), F.max(F.when(F.col("date") >= when - F.expr("INTERVAL 365 DAYS"), 1).otherwise(0)).alias("recent"))
    weighed = history.select("buyer", "vendor", *[(F.col(f) * w).cast("long").alias(f) for f, w in FEATURES.items()])
    weighed = weighed.withColumn("score", sum((F.col(f) for f in FEATURES), F.lit(0)).cast("long"))
    # The best vendors of a buyer are the best of all its events: rank once, then join.
    best = weighed.withColumn("place", F.row_number().over(Window.partitionBy("buyer").orderBy(F.desc("score"), "vendor")).cast("long")).where(F.col("place") <= top)
    events = bids.where(F.col("date") >= when if active is None else active).select("event", "buyer").distinct()
    return events.join(best, "buyer").select("event", "vendor", *FEATURES, "score", "place")


def factors(scored: DataFrame) -> DataFrame:
    """Which features support a prediction and which are missing."""
    named = F.array(*[F.struct(F.lit(f).alias("name"), F.col(f).alias("value")) for f in FEATURES])
    names = lambda cond: F.array_join(F.transform(F.filter(named, cond), lambda x: x["name"]), ",")
    return scored.select("event", "vendor", names(lambda x: x["value"] > 0).alias("supporting"), names(lambda x: x["value"] == 0).alias("weakening"))


def scope_evidence(bids: DataFrame, scope: tuple[str, ...]) -> DataFrame:
    """(vendor, scope_wins, most_wins_with_one_buyer, capability_gap): awards in the categories of the scope, and which of them have none."""
    won = bids.where("won").groupBy("vendor", "buyer", "category").agg(F.count(F.lit(1)).alias("n"))
    by_buyer = won.groupBy("vendor", "buyer").agg(F.sum("n").alias("n"), *[F.sum(F.when(F.col("category") == s, F.col("n")).otherwise(0)).alias(f"in_{i}") for i, s in enumerate(scope)])
    parts = [F.sum(f"in_{i}") for i in range(len(scope))]
    gap = F.array_join(F.filter(F.array(*[F.when(p == 0, F.lit(s)) for p, s in zip(parts, scope, strict=True)]), lambda x: x.isNotNull()), ",")
    return by_buyer.groupBy("vendor").agg(sum(parts[1:], parts[0]).alias("scope_wins"), F.max("n").alias("most_wins_with_one_buyer"), gap.alias("capability_gap"))


def prime_candidates(profiles: DataFrame, rules: dict[str, Column], least: int, disqualified: DataFrame) -> DataFrame:
    """(vendor, evidence, n_evidence, capability_gap): vendors with at least `least` kinds of evidence that nothing disqualifies."""
    met = F.filter(F.array(*[F.when(ok, F.lit(n)) for n, ok in rules.items()]), lambda x: x.isNotNull())
    found = profiles.join(disqualified, "vendor", "left_anti").withColumn("e", met).where(F.size("e") >= least)
    return found.select("vendor", F.array_join("e", ",").alias("evidence"), F.size("e").cast("long").alias("n_evidence"), "capability_gap")


def precision_at(predicted: DataFrame, bids: DataFrame, ks: tuple[int, ...] = (3, 5), held: DataFrame | None = None) -> DataFrame:
    """Mean precision at each k, and the share of actual bidders that were predicted, over the events of `held`.

    Those without predictions have no hits, and their bidders are not covered.  Without `held`, only events with predictions count.
    """
    events = (predicted if held is None else held).select("event").distinct()
    actual = bids.join(events, "event", "left_semi").select("event", "vendor").distinct()
    hits = predicted.join(actual.withColumn("hit", F.lit(1)), ["event", "vendor"], "left").withColumn("hit", F.coalesce("hit", F.lit(0)))
    found = hits.agg(*[F.coalesce(F.sum(F.when(F.col("place") <= k, F.col("hit")).otherwise(0)), F.lit(0)).alias(f"h{k}") for k in ks], F.coalesce(F.sum("hit"), F.lit(0)).alias("found"))
    total = found.join(events.agg(F.count(F.lit(1)).alias("n_events"))).join(actual.agg(F.count(F.lit(1)).alias("n_actual")))  # one row each
    return total.select("n_events", *[F.round(F.try_divide(f"h{k}", F.col("n_events") * k), 6).alias(f"precision_at_{k}") for k in ks], F.round(F.try_divide("found", "n_actual"), 6).alias("coverage"))


#: Commodities of an event from which on it is compared with all that share one.
WIDE = 64


def similar_events(bids: DataFrame, of: DataFrame, top: int = 3) -> DataFrame:
    """(event, similar, common, either, place): events that share commodities with those of `of`, by Jaccard similarity.

    Most pairs share one commodity.  Of these only the `top` smallest others, ties by id, can be among an event's best, whatever else there is: each of them is at
    least as similar as all that come later.  So each commodity brings every event its `top` + 1 smallest events (it may be one of them), and pairs that share
    two commodities or more are found under pairs of commodities.  Events of more than WIDE commodities are compared with all that share one.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy("event"))
    items = Scratch(bids.sparkSession, "similar", sent=False).save(bids.select("event", "commodity").where("event IS NOT NULL").distinct().withColumn("n", n).where("commodity IS NOT NULL"), "items")
    asked = of.select("event").distinct()
    first = Window.partitionBy("commodity").orderBy("n", "event")
    small = items.withColumn("r", F.row_number().over(first)).where(F.col("r") <= top + 1).select("commodity", F.col("event").alias("similar"), F.col("n").alias("m"))
    one = items.join(asked, "event", "left_semi").join(small, "commodity").select("event", "similar", "n", "m", F.lit(1).cast("long").alias("common"))

    narrow = items.where(F.col("n").between(2, WIDE)).groupBy("event", "n").agg(F.sort_array(F.collect_list("commodity")).alias("c"))
    each = F.flatten(F.transform("c", lambda x, i: F.transform(F.slice("c", i + 2, F.greatest(F.size("c") - i - 1, F.lit(0))), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    two = narrow.select("event", "n", F.explode(each).alias("p")).select("event", "n", "p.x", "p.y")
    # k common commodities are k (k - 1) / 2 common pairs.
    common = ((1 + F.sqrt(1 + 8 * F.count(F.lit(1)))) / 2).cast("long").alias("common")
    met = two.join(asked, "event", "left_semi").join(two.select(F.col("event").alias("similar"), F.col("n").alias("m"), "x", "y"), ["x", "y"])
    several = met.where("event <> similar").groupBy("event", "similar", "n", "m").agg(common).select("event", "similar", "n", "m", "common")

    wide = items.where(F.col("n") > WIDE)
    other = items.select(F.col("event").alias("similar"), F.col("n").alias("m"), "commodity")
    shared = wide.join(other, "commodity").groupBy("event", "similar", "n", "m").agg(F.count(F.lit(1)).alias("common"))
    back = shared.select(F.col("similar").alias("event"), F.col("event").alias("similar"), F.col("m").alias("n"), F.col("n").alias("m"), "common")
    large = shared.unionByName(back).join(asked, "event", "left_semi").select("event", "similar", "n", "m", "common")

    found = one.unionByName(several).unionByName(large).where("event <> similar").groupBy("event", "similar", "n", "m").agg(F.max("common").alias("common"))
    found = found.withColumn("either", F.col("n") + F.col("m") - F.col("common"))
    order = Window.partitionBy("event").orderBy(F.desc(F.col("common") / F.col("either")), "similar")
    return found.withColumn("place", F.row_number().over(order).cast("long")).where(F.col("place") <= top).select("event", "similar", "common", "either", "place")
