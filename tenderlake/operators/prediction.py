"""Likely bidders by a model: logistic regression on what was known before each event, calibrated, with contributions.

Candidates of an event are its actual bidders and, to learn from, vendors that did not bid, drawn by hash.  Their features come from as-of joins, so
no candidate sees anything of the event's day or later.  Spark ML fits the weights and the isotonic calibration (pool adjacent violators) in
tasks; what comes to the driver is a weight for each feature and the steps of the calibration.
"""

from __future__ import annotations

import dataclasses
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenderlake.operators.asof import as_of
from tenderlake.session import Scratch

#: All from before the event: the vendor's history with the buyer, in the category, with amounts of this size, at all, and how recent it is.
FEATURES = ("pair_bids", "pair_wins", "pair_recent", "is_incumbent", "category_bids", "category_wins", "vendor_bids", "vendor_win_rate", "vendor_recent", "size_fit")
#: Vendors drawn for an event that did not bid; days after which recency is 1/e; parts of 10 that calibrate; least probability that is called confident.
NEGATIVES, FADE, CALIBRATION, CONFIDENT = 4, 365.0, 3, 0.5
#: Parts in which vendors are numbered.
PARTS = 64
#: Held-out events whose candidates are scored in one round, and rounds at most: each reads the lists of all buyers and categories again.
EVENTS_PER_ROUND, ROUNDS = 50_000, 16


def _ago(ts: str) -> Column:
    """1 for yesterday, fading with the days since; 0 for never."""
    return F.coalesce(F.exp(-F.datediff(F.col("date").cast("date"), F.col(ts).cast("date")) / F.lit(FADE)), F.lit(0.0))


def _as_features(known: DataFrame, keep: list[str]) -> DataFrame:
    """The columns to keep and FEATURES, from what is known of each candidate (columns that begin with _)."""
    log = lambda c: F.log1p(F.coalesce(f"_{c}", F.lit(0)).cast("double"))
    usual = F.try_divide("_vendor_log", "_vendor_bids")
    made = {
        **{c: log(c) for c in ("pair_bids", "pair_wins", "category_bids", "category_wins", "vendor_bids")},
        "pair_recent": _ago("_pair_last"),
        "vendor_recent": _ago("_vendor_last"),
        "is_incumbent": F.coalesce((F.col("_incumbent") == F.col("vendor")).cast("double"), F.lit(0.0)),
        "vendor_win_rate": F.coalesce(F.try_divide(F.col("_vendor_wins").cast("double"), F.col("_vendor_bids")), F.lit(0.0)),
        "size_fit": F.coalesce(F.exp(-F.abs(F.when(F.col("amount") > 0, F.log("amount")) - usual)), F.lit(0.0)),
    }
    return known.select(*keep, *[made[f].alias(f) for f in FEATURES])


def candidate_features(candidates: DataFrame, bids: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """candidates (event, vendor, buyer, category, amount, date, ...) with FEATURES as doubles; bids are (event, vendor, buyer, category, amount, date, won).

    amount is what the event is worth, as far as known beforehand.  Counts enter by their logarithm; what is unknown is 0 here, as a
    model needs a number: the history of an unknown vendor, buyer or category is no evidence for it.

    Each join is written before the next reads it, so that the disk holds the shuffle of one join only; a join also counts its keys first, and
    would make all earlier ones again for that.  What is written goes with `scratch`, if given, else when the driver ends.
    """
    scratch = scratch or Scratch(candidates.sparkSession, "known", kept=False)
    one = F.lit(1).cast("long")
    wins = F.when(F.col("won"), 1).otherwise(0).cast("long")
    past = bids.select("vendor", "buyer", "category", "amount", "date", "event", "won")
    joins = (
        (past, ["vendor", "buyer"], ["event"], {"_pair_last": F.col("date")}, {"_pair_bids": one, "_pair_wins": wins}),
        (past, ["vendor", "category"], ["event"], {}, {"_category_bids": one, "_category_wins": wins}),
        (past, ["vendor"], ["event"], {"_vendor_last": F.col("date")}, {"_vendor_bids": one, "_vendor_wins": wins, "_vendor_log": F.when(F.col("amount") > 0, F.log("amount"))}),
        (past.where("won"), ["buyer"], ["event", "vendor"], {"_incumbent": F.col("vendor")}, {}),
    )
    out = scratch.save(candidates, "candidates")
    for right, key, order, last, sums in joins:
        told = scratch.save(as_of(out, right, key, "date", order, last, sums), "known")
        scratch.drop(out)
        out = told
    return _as_features(out, candidates.columns)


def events_of(bids: DataFrame) -> DataFrame:
    """(event, buyer, date, category, amount): category and amount are those of the event's largest bid (they stand for what its notice says)."""
    largest = F.struct("amount", "category")
    return bids.groupBy("event").agg(F.min("buyer").alias("buyer"), F.min("date").alias("date"), F.max_by("category", largest).alias("category"), F.max("amount").alias("amount"))


def training_pairs(bids: DataFrame, negatives: int = NEGATIVES) -> DataFrame:
    """(event, vendor, buyer, date, category, amount, label): each actual bidder of each event, and `negatives` draws of others.

    A draw is a number of a vendor by hash of event and draw; draws that hit a bidder or each other count once or not at all.
    """
    events = events_of(bids)
    actual = bids.where("vendor IS NOT NULL").select("event", "vendor").distinct()
    # Numbers within parts by hash, so that no task numbers all vendors; a draw is one of the parts that have any, and a number there.
    part = F.pmod(F.xxhash64("vendor"), F.lit(PARTS)).alias("part")
    vendors = actual.select("vendor").distinct().select("vendor", part).withColumn("number", F.row_number().over(Window.partitionBy("part").orderBy("vendor")))
    sizes = vendors.groupBy("part").agg(F.max("number").alias("most"))
    every = Window.partitionBy(F.lit(1))  # PARTS rows at most
    sizes = sizes.select("part", "most", F.row_number().over(every.orderBy("part")).alias("slot"), F.count(F.lit(1)).over(every).alias("slots"))
    slots = sizes.agg(F.max("slots").alias("slots"))
    drawn = events.select("event", F.explode(F.sequence(F.lit(1), F.lit(negatives))).alias("draw")).withColumn("h", F.xxhash64("event", "draw")).join(F.broadcast(slots))
    drawn = drawn.withColumn("slot", 1 + F.pmod("h", "slots")).drop("slots").join(F.broadcast(sizes), "slot").withColumn("number", (1 + F.pmod(F.shiftright("h", 16), F.col("most"))).cast("int"))
    others = drawn.join(vendors, ["part", "number"]).select("event", "vendor").distinct().join(actual, ["event", "vendor"], "left_anti")
    both = actual.withColumn("label", F.lit(1.0)).unionByName(others.withColumn("label", F.lit(0.0)))
    return both.join(events, "event")


@dataclasses.dataclass
class Model:
    """Weights of the raw features, the intercept, and the calibration's steps."""

    weights: dict[str, float]
    intercept: float
    bounds: list[float]
    values: list[float]

    def raw(self) -> Column:
        return sum((F.col(f) * w for f, w in self.weights.items()), F.lit(self.intercept))

    def score(self, df: DataFrame) -> DataFrame:
        """df with contributions (structs of name and value, log-odds), raw_score, probability and confident."""
        parts = F.array(*[F.struct(F.lit(f).alias("name"), (F.col(f) * w).alias("value")) for f, w in self.weights.items()])
        out = df.withColumns({"contributions": parts, "raw_score": self.raw()})
        return out.withColumn("probability", self._calibrated(F.col("raw_score"))).withColumn("confident", F.col("probability") >= CONFIDENT)

    def _calibrated(self, x: Column) -> Column:
        """Straight lines between the steps, flat outside."""
        b, v = self.bounds, self.values
        if not b:
            return 1 / (1 + F.exp(-x))
        out = F.when(x <= b[0], v[0])
        for i in range(1, len(b)):
            share = (x - b[i - 1]) / (b[i] - b[i - 1]) if b[i] > b[i - 1] else F.lit(1.0)
            out = out.when(x <= b[i], v[i - 1] + share * (v[i] - v[i - 1]))
        return out.otherwise(v[-1])


#: Steps of a calibration at most: scores are averaged in so many parts of equal size before violators are pooled.
STEPS = 50


def fit(pairs: DataFrame, event: str = "event") -> Model:
    """Weights from seven tenths of the events (by hash), calibration from the others; pairs have FEATURES and label.

    Without both labels the model is indifferent.
    """
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="_x").transform(pairs)
    part = F.pmod(F.xxhash64(event), F.lit(10)) < CALIBRATION
    learn = vector.where(~part)
    if learn.agg(F.count_distinct("label")).first()[0] < 2:
        return Model(dict.fromkeys(FEATURES, 0.0), 0.0, [], [])
    found: LogisticRegressionModel = LogisticRegression(featuresCol="_x", labelCol="label", regParam=1e-3, maxIter=60, tol=1e-6).fit(learn)
    bare = Model(dict(zip(FEATURES, map(float, found.coefficients), strict=True)), float(found.intercept), [], [])
    return calibrate(bare, pairs.where(part))


def calibrate(model: Model, pairs: DataFrame) -> Model:
    """The model with its scores made probabilities by isotonic regression on these pairs."""
    scored = model.score(pairs).select("raw_score", "label")
    cuts = sorted(set(scored.approxQuantile("raw_score", [i / STEPS for i in range(1, STEPS)], 0.001)))
    if not cuts:
        return model
    of = F.array_size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("raw_score")))
    means = scored.groupBy(of.alias("step")).agg(F.avg("raw_score").alias("raw"), F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))
    found: IsotonicRegressionModel = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight").fit(means)
    return dataclasses.replace(model, bounds=list(map(float, found.boundaries)), values=list(map(float, found.predictions)))


def histories(old: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What is known from all of `old`, whose vendors and dates are known: by buyer and vendor, by category and vendor (both with places), by vendor, and each buyer's incumbent."""
    one, wins = F.count(F.lit(1)), F.count_if("won")

    def usual(by: str, name: str, *more: Column) -> DataFrame:
        n = old.where(F.col(by).isNotNull()).groupBy(by, "vendor").agg(one.alias(f"_{name}_bids"), wins.alias(f"_{name}_wins"), *more)
        return n.withColumn(f"_{name}_place", F.row_number().over(Window.partitionBy(by).orderBy(F.desc(f"_{name}_bids"), "vendor")))

    log = F.coalesce(F.sum(F.when(F.col("amount") > 0, F.log("amount"))), F.lit(0.0))
    vendors = old.groupBy("vendor").agg(F.max("date").alias("_vendor_last"), one.alias("_vendor_bids"), wins.alias("_vendor_wins"), log.alias("_vendor_log"))
    incumbents = old.where("won").groupBy("buyer").agg(F.max_by("vendor", F.struct("date", "event", "vendor")).alias("_incumbent"))
    return usual("buyer", "pair", F.max("date").alias("_pair_last")), usual("category", "category"), vendors, incumbents


def features_after(events: DataFrame, old: DataFrame, pool: int, known: tuple[DataFrame, DataFrame, DataFrame, DataFrame] | None = None) -> DataFrame:
    """(event, vendor, FEATURES) of the candidates (see predicted_bidders) of events that are later than all of `old`, whose vendors and dates are known.

    All of `old` is before each of them, so sums by key take the place of as-of joins (`known`, if they are there already).  What depends on the buyer's
    list or the category's list alone is joined to the lists, and a vendor of both comes from the buyer's, so that candidates are shuffled once for what is left.
    """
    pairs, kinds, vendors, incumbents = known or histories(old)
    told = events.select("event", "buyer", "category", "amount", "date").distinct().join(incumbents, "buyer", "left")
    by_buyer = told.join(pairs.where(F.col("_pair_place") <= pool).join(vendors, "vendor"), "buyer").join(kinds.drop("_category_place"), ["vendor", "category"], "left")
    by_kind = told.join(kinds.where(F.col("_category_place") <= pool).join(vendors, "vendor"), "category").join(pairs, ["vendor", "buyer"], "left")
    by_kind = by_kind.where(F.col("_pair_place").isNull() | (F.col("_pair_place") > pool)).drop("_category_place")
    return _as_features(by_buyer.unionByName(by_kind), ["event", "vendor"])


def predicted_bidders(model: Model, events: DataFrame, bids: DataFrame, cutoff: str, top: int = 5, pool: int = 25) -> DataFrame:
    """(event, vendor, place, probability, confident, contributions, raw_score): the `top` of each event's candidates.

    Candidates are the `pool` vendors that bid most often for the buyer before the cutoff, or else in the event's category; both lists are made
    once for each buyer and category, not for each event.
    """
    when = F.lit(cutoff).cast("timestamp")
    old = bids.where((F.col("date") < when) & F.col("vendor").isNotNull())

    def usual(by: str) -> DataFrame:
        n = old.where(F.col(by).isNotNull()).groupBy(by, "vendor").agg(F.count(F.lit(1)).alias("n"))
        return n.withColumn("r", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), "vendor"))).where(F.col("r") <= pool).select(by, "vendor")

    scratch = Scratch(bids.sparkSession, "predicted", kept=False)
    events = scratch.save(events, "events")
    early, late = events.where(F.col("date").isNull() | (F.col("date") < when)), events.where(F.col("date") >= when)
    lists = Scratch(bids.sparkSession, "histories", sent=False, kept=False)
    known = tuple(lists.save(df, "history") for df in histories(old))
    # Contributions are told of the best only: they would be most of what is shuffled.
    best = Window.partitionBy("event").orderBy(F.desc("raw_score"), "vendor")

    def placed(found: DataFrame) -> DataFrame:
        return scratch.save(found.withColumn("raw_score", model.raw()).withColumn("place", F.row_number().over(best).cast("long")).where(F.col("place") <= top), "placed")

    # An event has all of its candidates in one round, and the disk holds the shuffles of one round.
    n = min(ROUNDS, -(-events.count() // EVENTS_PER_ROUND)) or 1
    parts = [placed(features_after(late.where(F.pmod(F.xxhash64("event"), F.lit(n)) == r), old, pool, known)) for r in range(n)]
    if not early.isEmpty():
        both = [early.join(usual(by), by).select(*events.columns, "vendor") for by in ("buyer", "category")]
        parts.append(placed(candidate_features(both[0].unionByName(both[1]).distinct(), old).select("event", "vendor", *FEATURES)))
    scratch.drop(events)
    lists.clear()
    return model.score(reduce(DataFrame.unionByName, parts)).select("event", "vendor", "place", "probability", "confident", "contributions", "raw_score")
