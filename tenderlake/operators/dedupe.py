"""Exact and fuzzy duplicates, content hashes, and identity resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenderlake.session import Scratch


def exact_duplicates(df: DataFrame, key: Column, id_col: str, provenance: str) -> DataFrame:
    """One row per key that several rows share: how many, the first, and from how many origins."""
    return df.groupBy(key.alias("content_hash")).agg(F.count(F.lit(1)).alias("n_rows"), F.min(id_col).alias("first_id"), F.count_distinct(provenance).alias("n_origins")).where("n_rows > 1")


def keep_first(df: DataFrame, key: Column, id_col: str, provenance: str) -> DataFrame:
    """One row per content: the smallest id stays, all origins are retained."""
    return df.groupBy(key.alias("content_hash")).agg(F.min(id_col).alias("kept_id"), F.count(F.lit(1)).alias("n_copies"), F.array_join(F.sort_array(F.collect_set(provenance)), ",").alias("origins"))


def shingled(df: DataFrame, text: str, width: int) -> DataFrame:
    """df with `set` in place of the text: distinct hashes of runs of `width` words, without case; shorter texts have none.

    The words come out of a generator of one row, because an expression that a lambda refers to
    would be evaluated anew for every element.
    """
    words = F.split(F.btrim(F.regexp_replace(F.lower(text), r"\s+", " ")), " ")
    once = df.select(*[c for c in df.columns if c != text], F.explode(F.array(words)).alias("_w"))
    runs = F.transform(F.sequence(F.lit(1), F.size("_w") - width + 1), lambda i: F.xxhash64(F.slice("_w", i, F.lit(width))))
    return once.withColumn("set", F.when(F.size("_w") >= width, F.array_distinct(runs)).otherwise(F.array().cast("array<bigint>"))).drop("_w")


def near_texts(df: DataFrame, id_col: str, text: str, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(id_col, text) of the texts that may have a near copy or an exact one (see fuzzy_pairs); none that has one is missing.

    Two sets this similar differ from what they share by at most few(n) = n - ceil(n * num / den) shingles.  So of the 2 * few(n) + 1 smallest shingles of a
    set, few(n) + 1 at least are the other's as well, and where the largest of these is smaller than the other's, they are among the other's smallest.  As
    the other set has ceil(n * num / den) shingles at least, this many shared ones (`need`) are known for both without seeing the rest: only
    the smallest are shuffled and counted, and texts that share fewer go no further.
    """
    scratch = Scratch(df.sparkSession, "near", sent=False, kept=False)
    part = lambda n: F.ceil(n * num / den)
    sample = lambda n: F.least(n, 2 * (n - part(n)) + 1)
    need = lambda n: sample(n) - (n - part(n))
    sets = shingled(df.where(F.col(text).isNotNull()).select(F.col(id_col).alias("id"), F.col(text).alias("text")), "text", width)
    sets = sets.select("id", F.size("set").alias("n"), F.sort_array("set").alias("set")).where("n > 0")
    some = sets.select("id", "n", F.explode(F.slice("set", F.lit(1), sample(F.col("n")).cast("int"))).alias("s"))
    shared = some.withColumn("freq", F.count(F.lit(1)).over(Window.partitionBy("s"))).where("freq > 1")
    ids = scratch.save(shared.groupBy("id", "n").agg(F.count(F.lit(1)).alias("met")).where(F.col("met") >= need(part(F.col("n")))).select(F.col("id").alias(id_col)), "ids")
    near = scratch.save(df.select(id_col, text).join(ids, id_col, "left_semi"), "near")
    scratch.drop(ids)
    return near


def fuzzy_pairs(df: DataFrame, id_col: str, text: str, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(id_a, id_b, common, either): pairs of distinct texts whose shingle sets have den * common >= num * either.

    Equal texts are one class, named by its smallest id.  Only texts that may have a near copy are compared.
    """
    return pairs_among(near_texts(df, id_col, text, width, num, den), id_col, text, width, num, den)


def pairs_among(df: DataFrame, id_col: str, text: str, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """fuzzy_pairs of these texts.

    Two sets this similar share one of their
    rarest shingles (the first n - ceil(n * num / den) + 1 in the order of frequency), so only those are
    joined; the sets of the pairs found are then compared in full.  A shingle of one set only is rarest and pairs nobody: it has to be counted, and
    what several sets have is all that goes back to its set.
    """
    scratch = Scratch(df.sparkSession, "fuzzy", sent=False, kept=False)
    classes = df.where(F.col(text).isNotNull()).groupBy(F.sha2(text, 256)).agg(F.min(id_col).alias("id"), F.any_value(text).alias("text"))
    sets = shingled(classes.select("id", "text"), "text", width).where(F.size("set") > 0)
    one = sets.select("id", F.size("set").alias("n"), F.explode("set").alias("s"))
    shared = one.withColumn("freq", F.count(F.lit(1)).over(Window.partitionBy("s"))).where("freq > 1")
    held = shared.groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("freq", "s"))).getField("s").alias("held"))
    held = scratch.save(held, "held")
    first = (F.ceil(F.col("n") * num / den) * -1 + 1 + F.size("held")).cast("int")  # less the shingles of this set only
    prefix = held.where(first > 0).select(F.explode(F.slice("held", F.lit(1), first)).alias("s"), "id", "n")
    a, b = prefix.select("s", F.col("id").alias("id_a"), F.col("n").alias("n_a")), prefix.select("s", F.col("id").alias("id_b"), F.col("n").alias("n_b"))
    close = F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num
    pairs = a.join(b, "s").where((F.col("id_a") < F.col("id_b")) & close).select("id_a", "id_b").distinct()
    side = lambda p: held.select(F.col("id").alias(f"id_{p}"), F.col("n").alias(f"n_{p}"), F.col("held").alias(f"held_{p}"))
    common = F.size(F.array_intersect("held_a", "held_b"))
    met = pairs.join(side("a"), "id_a").join(side("b"), "id_b").select("id_a", "id_b", common.cast("long").alias("common"), (F.col("n_a") + F.col("n_b") - common).cast("long").alias("either"))
    return met.where(F.col("common") * den >= F.col("either") * num)


#: Legal forms of companies, as they stand at the end of a name (fixed values).
LEGAL_FORMS = ("ab", "ag", "as", "bv", "co", "company", "corp", "corporation", "gmbh", "inc", "incorporated", "kg", "limited", "llc", "llp", "lp", "ltd", "nv", "oy", "plc", "pllc", "pte", "pty", "sa", "sarl", "srl")


def normalized_name(name: Column) -> Column:
    """Lower case, the letters and digits of all scripts, without legal forms at the end (`L.L.C.` is one); '' where nothing else is left."""
    short = F.regexp_replace(F.lower(name), r"(?<=(?:^|[^\p{L}\p{N}])\p{L})\.(?=\p{L}(?:[^\p{L}\p{N}]|$))", "")
    plain = F.rtrim(F.concat(F.lit(" "), F.regexp_replace(short, r"[^\p{L}\p{M}\p{N}]+", " ")))
    return F.btrim(F.regexp_replace(plain, rf"(?: +(?:{'|'.join(LEGAL_FORMS)}))+$", ""))


def resolve_identities(entities: DataFrame) -> DataFrame:
    """(entity, resolved, n_aliases, verdict) of (entity, name, place), a row for each distinct record.

    Two records are one vendor if their normalised names agree and their place does too; a name alone
    goes to review, so that unrelated companies are not merged.  Null, empty and merely legal names match nothing, null
    places none but by name.
    """
    norm = normalized_name(F.col("name"))
    named = entities.select("entity", "name", "place").distinct().withColumn("name", F.when(norm != "", norm))
    places = named.where("name IS NOT NULL AND place IS NOT NULL").groupBy("name", "place").agg(F.min("entity").alias("resolved"), F.count_distinct("entity").alias("n_aliases"))
    names = named.where("name IS NOT NULL").groupBy("name").agg(F.count_distinct("entity").alias("same_name"))
    found = named.join(places, ["name", "place"], "left").join(names, "name", "left")
    verdict = F.when(F.col("n_aliases") > 1, "resolved").when(F.col("same_name") > 1, "review").otherwise("single")
    return found.select("entity", F.coalesce("resolved", "entity").alias("resolved"), F.coalesce("n_aliases", F.lit(1)).cast("long").alias("n_aliases"), verdict.alias("verdict"))


def connected(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label): the smallest node that each node of the edges (a, b) reaches.

    Labels go down to the smallest of a node's neighbours and then to their labels' labels, over stored tables, until
    none changes, so that distances halve with each round.
    """
    both = scratch.save(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "both")
    labels = scratch.save(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("label").alias("l"))
        near = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("l").alias("l"))
        lower = labels.join(near, "node").select("node", F.least("label", "l").alias("at"), F.col("label").alias("old"))
        jump = lower.join(of.select(F.col("b").alias("at"), "l"), "at", "left").select("node", F.least("at", F.coalesce("l", "at")).alias("label"), "old")
        new = scratch.save(jump, "labels")
        if new.where("label <> old").isEmpty():
            return new.select("node", "label")
        labels = new.drop("old")


def names_alike(a: Column, b: Column) -> Column:
    """Whether normalised names have half of the words of both in common, an edit similarity of 0.85 and the same digits."""
    digits = lambda c: F.regexp_replace(c, r"[^\p{N}]", "")
    words = [F.array_distinct(F.split(c, " ")) for c in (a, b)]
    common = F.size(F.array_intersect(*words))
    return (2 * common >= F.size(words[0]) + F.size(words[1]) - common) & (digits(a) == digits(b)) & (100 * F.levenshtein(a, b) <= 15 * F.greatest(F.length(a), F.length(b)))


def similar_names(names: DataFrame) -> DataFrame:
    """(a, b) of (id, norm, place), a row for each name of a place: ids of alike names of one place, found under their rarest words (an exact prefix filter)."""
    words = names.select("id", "norm", "place", F.explode(F.array(F.array_distinct(F.split("norm", " ")))).alias("words"))
    one = words.select("id", "norm", "place", "words", F.explode("words").alias("word"))
    ranked = one.join(one.groupBy("place", "word").agg(F.count(F.lit(1)).alias("freq")), ["place", "word"])
    ranked = ranked.withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy("freq", "word"))).where((F.col("r") <= F.size("words") - F.ceil(F.size("words") / 2) + 1) & (F.col("freq") > 1))
    x, y = (ranked.select("place", "word", *[F.col(c).alias(f"{c}_{p}") for c in ("id", "norm")]) for p in "ab")
    return x.join(y, ["place", "word"]).where((F.col("id_a") < F.col("id_b")) & names_alike(F.col("norm_a"), F.col("norm_b"))).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def resolve_vendors(entities: DataFrame) -> DataFrame:
    """(entity, resolved, n_aliases, verdict) of (entity, name, place, tax_id): blocking, pair scores, components.

    Records are one vendor if their tax ids agree, if their normalised names and places do, or if they are of one place
    and their names are alike.  Where such links would bring two tax ids together nothing is merged: the records go to
    review, as do those whose name some other record has.  Null, empty and merely legal names match nothing; repeated rows
    count once.  See `linkage` for weights, scores and reasons.
    """
    scratch = Scratch(entities.sparkSession, "vendors")
    norm = normalized_name(F.col("name"))
    named = scratch.save(entities.select("entity", F.when(norm != "", norm).alias("norm"), "place", "tax_id").distinct(), "named")
    firsts = named.where("tax_id IS NOT NULL").groupBy("tax_id").agg(F.min("entity").alias("a"))
    by_tax = named.join(firsts, "tax_id").select("a", F.col("entity").alias("b"))
    classes = scratch.save(named.where("norm IS NOT NULL").groupBy("norm", "place").agg(F.min("entity").alias("id")), "classes")
    by_name = named.join(classes, ["norm", "place"]).select(F.col("id").alias("a"), F.col("entity").alias("b"))
    similar = similar_names(classes.where("place IS NOT NULL"))
    labels = connected(scratch.save(by_tax.unionByName(by_name).unionByName(similar), "edges"), scratch)
    placed = named.join(labels.withColumnRenamed("node", "entity"), "entity", "left").withColumn("label", F.coalesce("label", "entity"))
    sizes = placed.groupBy("label").agg(F.count_distinct("entity").alias("n"), F.count_distinct("tax_id").alias("taxes"))
    elsewhere = named.where("norm IS NOT NULL").groupBy("norm").agg(F.count_distinct("entity").alias("held"))
    met = placed.join(sizes, "label").join(elsewhere, "norm", "left")
    verdict = F.when(F.col("taxes") > 1, "review").when(F.col("n") > 1, "resolved").when(F.col("held") > 1, "review").otherwise("single")
    return met.select("entity", F.when(F.col("taxes") > 1, F.col("entity")).otherwise(F.col("label")).alias("resolved"), F.when(F.col("taxes") > 1, 1).otherwise(F.col("n")).cast("long").alias("n_aliases"), verdict.alias("verdict"))
