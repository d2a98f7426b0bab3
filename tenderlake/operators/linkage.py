"""Probabilistic record linkage of vendors: Fellegi-Sunter weights, fitted by EM, and clusters that refuse contradictions.

Records (entity, name, place, tax_id) with the same normalised name, place and tax id are one class; pairs are of classes.
Candidates are formed with one class of each tax id and each name instead of all pairs of them, and by the rarest words of
similar names of a place.  A pair agrees in name (2: equal, 1: similar, 0: not), place and tax id (1, 0), or that is unknown (-1),
which speaks neither for nor against it.

How often two records agree by chance is counted over all of them; how often two of one vendor do comes from EM over the
counts of comparison patterns, of which there are at most 36.  A rare name counts more than a common one.
"""

from __future__ import annotations

import dataclasses
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.operators import dedupe
from tenderlake.session import Scratch

LEVELS = {"name": (2, 1, 0), "place": (1, 0), "tax": (1, 0)}
#: Where EM starts: how often two records of one vendor are at each level, and the share of such pairs among the candidates.
START = {"name": (0.6, 0.3, 0.1), "place": (0.9, 0.1), "tax": (0.95, 0.05)}
SHARE = 0.5
ITERATIONS = 30
#: Added to each level's expected count, so that none has probability 0.
SMOOTH = 0.5
#: Probabilities from which on a pair is a match, or worth a look.
MATCH, POSSIBLE = 0.95, 0.5


@dataclasses.dataclass
class Model:
    """By field, the probability of each level for pairs of one vendor and for others, and the share of the former among candidates."""

    same: dict[str, tuple[float, ...]]
    other: dict[str, tuple[float, ...]]
    share: float
    n: int

    def weight(self, field: str, level: int) -> float:
        at = LEVELS[field].index(level)
        return math.log2(self.same[field][at] / self.other[field][at])


def classes_of(records: DataFrame) -> DataFrame:
    """(id, norm, place, tax, n): records that agree in all of them; those with neither place nor tax id are classes of their own, and those with neither name nor tax id are left out."""
    norm = dedupe.normalized_name(F.col("name"))
    named = records.select("entity", F.when(norm != "", norm).alias("norm"), "place", F.col("tax_id").alias("tax")).where("norm IS NOT NULL OR tax IS NOT NULL")
    own = F.when(F.col("place").isNull() & F.col("tax").isNull(), F.col("entity"))
    return named.groupBy("norm", "place", "tax", own.alias("own")).agg(F.min("entity").alias("id"), F.count_distinct("entity").alias("n")).select("id", "norm", "place", "tax", "n")


def candidates(classes: DataFrame) -> DataFrame:
    """(a, b), a < b: with the first class of the same tax id; untaxed classes with the taxed ones of their name and place; the first untaxed class of a name with its classes elsewhere; similar names of a place."""
    taxed, untaxed = classes.where("tax IS NOT NULL"), classes.where("tax IS NULL")
    by_tax = taxed.join(taxed.groupBy("tax").agg(F.min("id").alias("hub")), "tax").select(F.col("hub").alias("a"), F.col("id").alias("b"))
    here = untaxed.select("norm", "place", F.col("id").alias("a")).join(taxed.select("norm", "place", F.col("id").alias("b")), ["norm", "place"]).select("a", "b")
    hubs = untaxed.groupBy("norm").agg(F.min(F.struct("id", "place")).alias("hub"))
    elsewhere = classes.join(hubs, "norm").where(~F.coalesce(F.col("place") == F.col("hub.place"), F.lit(False))).select(F.col("hub.id").alias("a"), F.col("id").alias("b"))
    names = classes.where("norm IS NOT NULL AND place IS NOT NULL").groupBy("norm", "place").agg(F.coalesce(F.min(F.when(F.col("tax").isNull(), F.col("id"))), F.min("id")).alias("id"))
    pairs = by_tax.unionByName(here).unionByName(elsewhere).unionByName(dedupe.similar_names(names))
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def compared(classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs with the level of each field, and the name that both share, if they do."""
    side = lambda p: classes.select(F.col("id").alias(p), *[F.col(c).alias(f"{c}_{p}") for c in ("norm", "place", "tax")])
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    known = lambda c: F.col(f"{c}_a").isNotNull() & F.col(f"{c}_b").isNotNull()
    equal = lambda c: F.col(f"{c}_a") == F.col(f"{c}_b")
    name = F.when(~known("norm"), -1).when(equal("norm"), 2).when(dedupe.names_alike(F.col("norm_a"), F.col("norm_b")), 1).otherwise(0)
    two = {c: F.when(~known(c), -1).when(equal(c), 1).otherwise(0).alias(c) for c in ("place", "tax")}
    return met.select("a", "b", name.alias("name"), *two.values(), F.when(equal("norm"), F.col("norm_a")).alias("norm"))


def chance(classes: DataFrame, pairs: DataFrame) -> tuple[dict[str, tuple[float, ...]], int]:
    """How often two records agree by chance, and the number of records: sums over values, by partial aggregation.

    Similar names are counted where they are candidates, against all pairs of a place.
    """
    two = F.col("c").cast("double") * (F.col("c") - 1) / 2

    def agreeing(field: str) -> tuple[float, float]:
        """Pairs that agree, and all pairs of records that have the field."""
        by = classes.where(F.col(field).isNotNull()).groupBy(field).agg(F.sum("n").alias("c"))
        same, known = by.agg(F.coalesce(F.sum(two), F.lit(0.0)), F.coalesce(F.sum("c"), F.lit(0))).first()
        return same, known * (known - 1) / 2

    places, taxes, names = agreeing("place"), agreeing("tax"), agreeing("norm")
    side = lambda p: classes.select(F.col("id").alias(p), F.col("n").alias(f"n_{p}"))
    similar = pairs.where("name = 1 AND place = 1").join(side("a"), "a").join(side("b"), "b").agg(F.coalesce(F.sum(F.col("n_a").cast("double") * F.col("n_b")), F.lit(0.0))).first()[0]
    odds = lambda x: (x[0] + SMOOTH) / (x[1] + 2 * SMOOTH)
    equal, close = odds(names), (similar + SMOOTH) / (places[0] + 2 * SMOOTH)
    close = min(close, (1 - equal) / 2)
    return {"name": (equal, close, 1 - equal - close), "place": (odds(places), 1 - odds(places)), "tax": (odds(taxes), 1 - odds(taxes))}, int(classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])


def expectation_maximisation(patterns: list[tuple[int, int, int, int]], other: dict[str, tuple[float, ...]], n: int) -> Model:
    """From counts of (name, place, tax) levels: what pairs of one vendor look like, with chance agreement held fixed."""
    same, share, fields = dict(START), SHARE, list(LEVELS)
    for _ in range(ITERATIONS if patterns else 0):
        sums = {f: [SMOOTH] * len(LEVELS[f]) for f in fields}
        total = matched = 0.0
        for *levels, count in patterns:
            known = [(f, LEVELS[f].index(x)) for f, x in zip(fields, levels, strict=True) if x >= 0]
            yes = share * math.prod(same[f][i] for f, i in known)
            no = (1 - share) * math.prod(other[f][i] for f, i in known)
            p = yes / (yes + no)
            total, matched = total + count, matched + p * count
            for f, i in known:
                sums[f][i] += p * count
        same = {f: tuple(x / sum(v) for x in v) for f, v in sums.items()}
        share = (matched + SMOOTH) / (total + 2 * SMOOTH)
    return Model(same, other, share, n)


def fit(classes: DataFrame, pairs: DataFrame) -> Model:
    """The model of compared pairs; what comes to the driver is the counts of at most 36 patterns."""
    other, n = chance(classes, pairs)
    patterns = sorted(tuple(r) for r in pairs.groupBy("name", "place", "tax").count().collect())
    return expectation_maximisation(patterns, other, n)


def scored(classes: DataFrame, pairs: DataFrame, model: Model) -> DataFrame:
    """The compared pairs with `weight` (bits), `probability`, `reason` and `decision`: match, possible or no.

    Equal names weigh by their own frequency instead of the mean.  A match needs a tax id, or a name and a place; pairs with two tax
    ids are none, and equal names alone are possible, whatever their weight.
    """
    by_name = classes.where("norm IS NOT NULL").groupBy("norm").agg(F.sum("n").alias("held"))
    met = pairs.join(by_name, "norm", "left")
    part = lambda f: F.create_map(*[F.lit(x) for level in LEVELS[f] for x in (level, model.weight(f, level))])
    weights: list[Column] = [F.coalesce(F.try_element_at(part(f), F.col(f)), F.lit(0.0)) for f in LEVELS]
    rare = F.when(F.col("name") == 2, F.log2(F.lit(model.other["name"][0] * model.n) / F.col("held"))).otherwise(0.0)
    weight = weights[0] + weights[1] + weights[2] + rare
    odds = F.lit(math.log2(model.share / (1 - model.share)))
    met = met.withColumn("weight", weight).withColumn("probability", 1 / (1 + F.pow(F.lit(2.0), -(F.col("weight") + odds))))
    told = F.concat_ws(",", F.when(F.col("tax") == 1, "tax_id"), F.when(F.col("name") == 2, "name").when(F.col("name") == 1, "similar_name"), F.when(F.col("place") == 1, "place"))
    enough = (F.col("tax") == 1) | ((F.col("name") >= 1) & (F.col("place") == 1))
    decision = F.when(F.col("tax") == 0, "no").when(enough & (F.col("probability") >= MATCH), "match").when((F.col("probability") >= POSSIBLE) | (F.col("name") == 2), "possible").otherwise("no")
    return met.select("a", "b", "name", "place", "tax", "weight", "probability", told.alias("reason"), decision.alias("decision"))


def link(records: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, Scratch]:
    """Classes, scored pairs, the scores of classes of several records (a and b are the class), and records, all stored."""
    scratch = Scratch(records.sparkSession, "linkage")
    records = scratch.save(records.select("entity", "name", "place", "tax_id").distinct(), "records")
    classes = scratch.save(classes_of(records), "classes")
    pairs = scratch.save(compared(classes, candidates(classes)), "pairs")
    model = fit(classes, pairs)
    own = compared(classes, classes.where("n > 1").select(F.col("id").alias("a"), F.col("id").alias("b")))
    return classes, scratch.save(scored(classes, pairs, model), "scored"), scored(classes, own, model), records, scratch


def resolve(records: DataFrame) -> DataFrame:
    """(entity, resolved, n_aliases, verdict, score, reason) of (entity, name, place, tax_id), a row for each distinct record.

    Matches are followed to whole components.  One with several tax ids is a contradiction: only records that share a tax id stay
    together there, all others are left alone and go to review, as do those with a possible match.  score and reason are
    those of the record's best match.  Defined cases: a null, empty or merely legal name, and null places, match nothing; a record without
    name and tax id is single; repeated rows count once; ties of score go to the smaller pair; an empty table gives no rows.
    """
    classes, pairs, own, records, scratch = link(records)
    matches = pairs.where("decision = 'match'")
    labels = dedupe.connected(matches.select("a", "b"), scratch).withColumnRenamed("node", "id")
    placed = classes.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    taxes = placed.groupBy("label").agg(F.count_distinct("tax").alias("taxes"))
    firsts = classes.where("tax IS NOT NULL").groupBy("tax").agg(F.min("id").alias("first"))
    settled = placed.join(taxes, "label").join(firsts, "tax", "left").withColumn("resolved", F.when(F.col("taxes") <= 1, F.col("label")).otherwise(F.coalesce("first", "id")))

    both = lambda df: df.select(F.col("a").alias("id"), "weight", "reason", "decision", "a", "b").unionByName(df.select(F.col("b").alias("id"), "weight", "reason", "decision", "a", "b"))
    alike = own.select(F.col("a").alias("id"), "weight", "reason", F.lit("match").alias("decision"), "a", "b")
    best = both(pairs).where("decision <> 'no'").unionByName(alike).groupBy("id").agg(F.max_by(F.struct(F.round("weight", 6).alias("score"), "reason"), F.struct(F.when(F.col("decision") == "match", 1).otherwise(0), "weight", "b", "a")).alias("best"), F.count_if(F.col("decision") == "possible").alias("possible"))
    told = settled.join(best, "id", "left")
    norm = dedupe.normalized_name(F.col("name"))
    named = records.select("entity", F.when(norm != "", norm).alias("norm"), "place", F.col("tax_id").alias("tax"))
    own = F.when(F.col("place").isNull() & F.col("tax").isNull(), F.col("entity"))
    members = named.withColumn("own", own).alias("x").join(told.withColumn("own", F.when(F.col("place").isNull() & F.col("tax").isNull(), F.col("id"))).alias("y"), F.expr("x.norm <=> y.norm AND x.place <=> y.place AND x.tax <=> y.tax AND x.own <=> y.own"), "left")
    one = members.select("x.entity", F.coalesce("y.resolved", "x.entity").alias("resolved"), F.coalesce(F.col("taxes") > 1, F.lit(False)).alias("torn"), F.coalesce("possible", F.lit(0)).alias("possible"), F.col("best.score").alias("score"), F.col("best.reason").alias("reason"))
    sizes = one.groupBy("resolved").agg(F.count_distinct("entity").alias("n_aliases"))
    verdict = F.when(F.col("n_aliases") > 1, "resolved").when(F.col("torn") | (F.col("possible") > 0), "review").otherwise("single")
    return one.join(sizes, "resolved").select("entity", "resolved", "n_aliases", verdict.alias("verdict"), "score", "reason")
