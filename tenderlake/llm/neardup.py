"""Near-duplicate documents: MinHash signatures, multi-index Hamming join, exact confirmation, components.

1. Every text becomes its set of word shingles, as 64-bit hashes, a 128-bit fingerprint of
   the set and a signature of SYMBOLS minwise values of 8 bits.  Equal sets are one class.
2. Two sets of similarity s differ in a symbol with probability (1 - s) * 255 / 256.  The
   distance `most` lies SIGMAS standard deviations above what is expected at the threshold,
   so that of pairs exactly at it three to five in a million are further apart, of others fewer.
   By the pigeonhole principle two signatures within `most` agree up to r = most // CHUNKS
   errors in one of the first most % CHUNKS + 1 chunks, or up to r - 1 in one of the others;
   each chunk is indexed once for each set of places that may be wrong, so no pair within
   the distance is missed.
   Keys are 32 bits and more, so that chance brings few strangers together even among 10^9 sets.
3. Pairs are not emitted by bucket.  Each set is compared with the most central one, the hub, of
   the bucket where most of its keys agree.  In buckets that still hold several components, what every
   set differs in from the hub is stored, and an exact bound on these differences (see _across)
   says which others it may be linked with.  Hence every pair within the distance is compared, already
   connected, or shown to be no link; the pairs formed grow with the links, not with the square of a group.
4. Links are confirmed on the full shingle sets, and components are found by union-find in tasks of bounded size, whose stars are joined by alternating large-star and
   small-star steps on tables in the shared folder.

Nothing is broadcast or collected, so the driver's memory doesn't grow with the documents.

Defined cases: a null or empty text or one without words has an empty set and is linked with
nothing; fewer words than a shingle are one shingle together; rows with the same doc_id are one
document, which is linked by any of their texts; rows with a null doc_id are linked with nothing and stay; repeated rows get the
same answer each.  Texts count whole; other columns pass through.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .coded import save
from .common import Scratch, chunks, frugal, plain, spread, table

SYMBOLS, CHUNKS, SIGMAS = 100, 20, 4.75
LONGS = -(-SYMBOLS // 8)
#: Tasks at most over which the sets of one hub are dealt to be told of it.
SALTS = 64
#: Links that one task contracts.
LINKS_PER_TASK = 500_000
_RANDOM = np.random.default_rng(20)
_XOR = _RANDOM.integers(0, 1 << 32, SYMBOLS, dtype=np.uint32)
_ODD = _RANDOM.integers(0, 1 << 32, SYMBOLS, dtype=np.uint32) | np.uint32(1)
#: Shingles that are hashed at a time, so that the work stays in the CPU's cache.
BLOCK = 1 << 15
#: Bytes of text whose sets a worker holds at a time.
PIECE = 4 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    # The multipliers and shifts of a public mixing function (splitmix64).
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(col: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    low = pc.ascii_lower(plain(col))
    parts = pc.ascii_split_whitespace(low)
    offsets = np.asarray(parts.offsets, dtype=np.int64)
    coded = pc.dictionary_encode(parts.flatten())
    words = coded.dictionary.to_pylist()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    codes = np.asarray(coded.indices, dtype=np.int64)
    empty = words.index("") if "" in words else -1
    real = codes != empty
    before = np.concatenate(([0], np.cumsum(real)))
    bounds = before[offsets - offsets[0]]
    w = hashes[codes[real]]
    acc = _mix(w)
    for j in range(1, width):
        if len(w) > j:
            acc[:-j] = _mix(acc[:-j] * np.uint64(3) + w[j:])
    out = []
    for a, b in itertools.pairwise(bounds.tolist()):
        if b - a >= width:
            out.append(np.unique(acc[a : b - width + 1]))
        elif b > a:  # all words together, told from shingles by their number
            h = np.uint64(b - a)
            for x in w[a:b]:
                h = _mix(np.array([h], np.uint64) * np.uint64(5) + x)[0]
            out.append(np.array([h], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SYMBOLS bytes for each non-empty set."""
    out = np.zeros((len(sets), 8 * LONGS), np.uint8)
    at = 0
    while at < len(sets):
        end, n = at, 0
        while end < len(sets) and (end == at or n + len(sets[end]) <= BLOCK):
            n += len(sets[end])
            end += 1
        flat = np.concatenate(sets[at:end])
        x = (flat ^ (flat >> np.uint64(32))).astype(np.uint32)
        # Fixed value below: the multiplier of a public mixing function of 32 bits.
        starts = np.cumsum([0, *map(len, sets[at : end - 1])])
        for j in range(SYMBOLS):
            y = (x ^ _XOR[j]) * _ODD[j]
            y ^= y >> np.uint32(15)
            y *= np.uint32(0x2C1B3C6D)
            y ^= y >> np.uint32(12)
            out[at:end, j] = np.minimum.reduceat(y, starts) & np.uint32(255)
        at = end
    return out


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text_hash, text): a doc_id and the hash of one of its texts name that text."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))


def _features(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    names = ["doc_id", "text_hash", "n", "f1", "f2", *(f"s{i}" for i in range(LONGS))]

    def told(part):
        sets = shingle_sets(part.column(2), width)
        n = np.array([len(s) for s in sets])
        full = np.flatnonzero(n)
        longs = np.zeros((len(sets), LONGS), np.int64)
        longs[full] = signatures([sets[i] for i in full]).view(np.int64)
        f1 = [int(_mix(s + np.uint64(1)).sum().view(np.int64)) if len(s) else None for s in sets]
        f2 = [int((_mix(s) * _mix(~s)).sum().view(np.int64)) if len(s) else None for s in sets]
        return pa.record_batch([part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), *(pa.array(np.ascontiguousarray(longs[:, i])) for i in range(LONGS))], names=names)

    def run(batches):
        with frugal():
            for batch in batches:
                yield from map(told, chunks(batch, "text", PIECE))

    return _keyed(docs, doc_id, text).mapInArrow(run, ", ".join(f"{c} long" for c in names))


def allowed_distance(num: int, den: int) -> int:
    differ = (1 - num / den) * 255 / 256
    return min(SYMBOLS - 1, math.ceil(SYMBOLS * differ + SIGMAS * math.sqrt(SYMBOLS * differ * (1 - differ))))


def index_masks(most: int) -> list[dict[int, int]]:
    """{long: mask} of each key of a signature: a chunk without the places that may be wrong."""
    size, r = SYMBOLS // CHUNKS, most // CHUNKS
    out = []
    for c in range(CHUNKS):
        errors = r if c <= most % CHUNKS else r - 1
        for wrong in itertools.combinations(range(size), min(errors, size)) if errors >= 0 else ():
            masks: dict[int, int] = {}
            for place in (c * size + i for i in range(size) if i not in wrong):
                masks[place // 8] = masks.get(place // 8, 0) | 0xFF << 8 * (place % 8)
            out.append({at: m - (1 << 64) if m >> 63 else m for at, m in masks.items()})
    return out


def _distance(a: str, b: str):
    """Symbols in which the longs a0.. and b0.. differ."""
    total = F.lit(0)
    for i in range(LONGS):
        x = F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))
        for s in (4, 2, 1):
            x = x.bitwiseOR(F.shiftrightunsigned(x, s))
        total = total + F.bit_count(x.bitwiseAND(F.lit(0x0101010101010101)))
    return total


def _contracted(batches):
    """Union-find over one task's links (u, v): the links of each of its components become a star around its smallest id."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    with frugal():
        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                u, v = root(u), root(v)
                parent[max(u, v)] = min(u, v)
        pairs = [(x, r) for x in parent if (r := root(x)) != x]
        parent.clear()
        yield pa.record_batch([pa.array([x for x, _ in pairs], pa.int64()), pa.array([r for _, r in pairs], pa.int64())], names=["u", "v"])


def components(links: DataFrame, scratch: Scratch, per_task: int = LINKS_PER_TASK) -> DataFrame:
    """(id, component): the smallest id reachable over the links (a, b), for each id in a link; links is a stored table.

    Tasks of at most about per_task links each contract theirs to stars by union-find.  If there is more than one such
    task, large-star and small-star steps over tables in the shared folder join their stars.
    """
    tasks = -(-links.count() // per_task) or 1
    stars = links.select(F.col("a").alias("u"), F.col("b").alias("v")).coalesce(tasks).mapInArrow(_contracted, "u long, v long")
    edges, seen = scratch.save(stars, "edges"), None
    while tasks > 1:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).hint("merge")  # a union loses the hints of its sides
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.save(large.where("u <> v").distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        new = scratch.save(small.where("u <> v").distinct(), "small")
        now = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(edges, large)
        edges = new
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _compared(pairs: DataFrame, texts: DataFrame, width: int, schema: str, told) -> DataFrame:
    """Rows of `schema` for the pairs (a, b): told(sets of a, sets of b, numbers of their b, columns of a and b) gives a batch."""
    met = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")

    def run(batches):
        with frugal():
            for batch in batches:
                for part in chunks(batch, "ta", PIECE):
                    uniq = pc.dictionary_encode(part.column(3))  # one text is often the partner of many
                    yield told(shingle_sets(part.column(2), width), shingle_sets(uniq.dictionary, width), uniq.indices.to_pylist(), part.columns[:2])

    return met.mapInArrow(run, schema)


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose full sets have den * |both| >= num * |either|."""

    def told(sets_a, sets_b, at, ids):
        common = [len(np.intersect1d(s, sets_b[j], assume_unique=True)) for s, j in zip(sets_a, at, strict=True)]
        keep = [c > 0 and den * c >= num * (len(s) + len(sets_b[j]) - c) for c, s, j in zip(common, sets_a, at, strict=True)]
        return pa.record_batch(ids, names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _compared(pairs, texts, width, "a long, b long", told)


def _differences(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(id, hub, n, n_hub, items) of the pairs (a, b): the sizes of both sets, and what is in one of them only."""

    def told(sets_a, sets_b, at, ids):
        items = [np.setxor1d(s, sets_b[j], assume_unique=True).view(np.int64) for s, j in zip(sets_a, at, strict=True)]
        ends = np.cumsum([0, *map(len, items)])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*items, np.zeros(0, np.int64)])))
        sizes = [pa.array(map(len, sets_a), pa.int64()), pa.array([len(sets_b[j]) for j in at], pa.int64())]
        return pa.record_batch([*ids, *sizes, lists], names=["id", "hub", "n", "n_hub", "items"])

    return _compared(pairs, texts, width, "id long, hub long, n long, n_hub long, items array<long>", told)


def _across(diffs: DataFrame, labels: DataFrame, scratch: Scratch, num: int, den: int) -> DataFrame:
    """Links (a, b) between sets of different components that have a hub in common; diffs is a stored table.

    With u = den + num, v = den - num and d(x, y) the size of a symmetric difference, x and y are linked if
    u d(x, y) <= v (|x| + |y|).  Let A and B be what a and b differ in from their hub h, so that
    d(a, b) = |A| + |B| - 2 |A n B|.  Of a pair across components one set, a, is apart from h: u |A| > v (|a| + |h|).  Hence
        2 u |A n B| >= u |A| + u |B| - v (|a| + |b|)                                     for the pair,
        2 u |A n B| >= u |B| + v (|h| - |b|) + 1                                         whatever a is,
        (u + v) |A n B| >= u |A| - v (|a| + |h|)                                         whatever b is,
    about half of either.  With the items of each difference in one order, rare ones first, the first common item comes
    so early in both that the others can still make up the overlap.  Only pairs with such an item are formed: copies with
    changes of their own have none, so no pair of them is, and a group of them costs no more than its size.
    """
    u, v = den + num, den - num
    of = labels.withColumnRenamed("component", "c")
    told = diffs.join(of, "id", "left").withColumns({"c": F.coalesce("c", "id"), "d": F.size("items").cast("long")})
    hubs = told.groupBy("hub").agg(F.min("c").alias("c_low"), F.max("c").alias("c_high")).join(of.select(F.col("id").alias("hub"), F.col("c").alias("hub_c")), "hub", "left")
    hubs = scratch.save(hubs.withColumn("hub_c", F.coalesce("hub_c", "hub")).where("c_low <> hub_c OR c_high <> hub_c").select("hub", "hub_c"), "hubs")
    # Salted: one hub may have a large part of all sets.
    salted = hubs.select("hub", "hub_c", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    known = told.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, ["hub", "salt"]).drop("salt")
    known = known.withColumn("apart", F.col("c") != F.col("hub_c"))
    up = lambda x, by: F.floor((x + (by - 1)) / F.lit(by))
    least_any = F.greatest(F.lit(1), up(F.col("d") * u - (F.col("n") + F.col("n_hub")) * v, u + v))
    least_apart = F.greatest(F.lit(1), up(F.col("d") * u + (F.col("n_hub") - F.col("n")) * v + 1, 2 * u))
    # The places up to which a first common item may come: with sets that are apart from the hub, and with the others.
    with_apart = F.col("d") + 1 - F.when(F.col("apart"), F.greatest(least_any, least_apart)).otherwise(least_apart)
    with_near = F.when(F.col("apart"), F.col("d") + 1 - least_any).otherwise(0)
    known = known.withColumns({"with_apart": with_apart, "with_near": with_near})
    known = scratch.save(known.where("with_apart > 0 OR with_near > 0"), "known")
    scratch.drop(diffs)

    # Items that only one component holds, or none that is apart, pair nobody. They come first in the order, so that they
    # only have to be counted.
    each = known.select("hub", F.explode("items").alias("item"), "id", "n", "d", "c", "apart", "with_apart", "with_near")
    held = each.groupBy("hub", "item").agg(F.count(F.lit(1)).alias("sets"), F.min("c").alias("c_low"), F.max("c").alias("c_high"), F.max("apart").alias("any_apart"))
    held = scratch.save(held.where("c_low <> c_high AND any_apart").select("hub", "item", "sets"), "held")
    mine = Window.partitionBy("hub", "id")
    each = each.join(held, ["hub", "item"])
    each = each.withColumn("place", F.col("d") - F.count(F.lit(1)).over(mine) + F.row_number().over(mine.orderBy("sets", "item"))).drop("sets")
    each = scratch.save(each.where(F.col("place") <= F.greatest("with_apart", "with_near")), "each")
    side = lambda df, p: df.select("hub", "item", *[F.col(x).alias(f"{p}_{x}") for x in ("n", "d", "c", "apart", "with_apart", "with_near", "place")], F.col("id").alias(p))
    left, right = side(each.where("apart"), "a"), side(each.where("place <= with_apart"), "b")
    other = (F.col("a_c") != F.col("b_c")) & F.when(F.col("b_apart"), (F.col("a") < F.col("b")) & (F.col("a_place") <= F.col("a_with_apart"))).otherwise(F.col("a_place") <= F.col("a_with_near"))
    still = 1 + F.least(F.col("a_d") - F.col("a_place"), F.col("b_d") - F.col("b_place"))
    fits = 2 * u * still >= u * (F.col("a_d") + F.col("b_d")) - v * (F.col("a_n") + F.col("b_n"))
    pairs = left.join(right, ["hub", "item"]).where(other & fits).groupBy("a", "b").agg(F.min("hub").alias("hub"))
    full = lambda p: known.select(F.col("id").alias(p), "hub", F.col("n").alias(f"{p}_n"), F.col("items").alias(f"{p}_items"))
    pairs = scratch.save(pairs, "pairs")
    scratch.drop(each, held)
    met = pairs.join(full("a"), ["hub", "a"]).join(full("b"), ["hub", "b"])
    d = F.size("a_items") + F.size("b_items") - 2 * F.size(F.array_intersect("a_items", "b_items"))
    return met.where(d * u <= (F.col("a_n") + F.col("b_n")) * v).select("a", "b")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row: linked are documents with den * |both| >= num * |either| of their shingle sets."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup", sent=False)
    most = allowed_distance(num, den)
    masks = index_masks(most)
    sig = [f"s{i}" for i in range(LONGS)]

    feats = scratch.save(_features(docs, doc_id, text, width), "features")
    known = feats.where("n > 0 AND doc_id IS NOT NULL")
    classes = known.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.max("n").alias("n"), F.count(F.lit(1)).alias("rows"), *[F.max(s).alias(s) for s in sig])
    classes = classes.select("f1", "f2", "first.*", F.col("first.doc_id").alias("id"), "n", "rows", *sig)
    classes = scratch.save(classes, "classes")
    # A doc_id with several texts can be the first of several classes, which then need ids of their own.
    shared = scratch.save(classes.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", F.lit(True).alias("shared")), "shared")
    unnamed = not shared.isEmpty()
    if unnamed:
        own = F.when(F.col("shared"), F.xxhash64(F.lit("class"), "f1", "f2")).otherwise(F.col("id"))
        classes = scratch.save(classes.join(shared, "id", "left").withColumn("id", own).drop("shared"), "classes")
    repeated = not known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    # A set that is its own size away from the next possible one has no partner.
    nodes = classes.where(F.col("n") * den >= (F.col("n") + 1) * num).select("id", "n", *sig)

    keys = nodes.select("id", F.explode(F.array(*[F.xxhash64(F.lit(i), *[F.col(f"s{at}").bitwiseAND(F.lit(mask)) for at, mask in m.items()]) for i, m in enumerate(masks)])).alias("key"))
    buckets = scratch.save(keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "buckets")
    members = scratch.save(keys.join(buckets, "key"), "members")
    # A set whose keys many others have lies in the middle of its group, where most links go.
    central = members.groupBy("id").agg(F.sum("members").alias("rank"))
    hubs = scratch.save(members.join(central, "id").groupBy("key").agg(F.max_by("id", F.struct("rank", "id")).alias("hub")), "hubs")
    placed = scratch.save(members.join(hubs, "key").select("key", "id", "hub"), "placed")
    scratch.drop(buckets, members, hubs)

    def texts_of(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
        ids = scratch.save(classes.select("id", "doc_id", "text_hash").join(ids, "id", "left_semi"), "ids")
        # A task keeps its part of the ids, so the texts need not be sorted.
        texts = _keyed(docs, doc_id, text).where("text IS NOT NULL").join(ids.hint("shuffle_hash"), ["doc_id", "text_hash"]).select("id", "text")
        return save(scratch, texts.dropDuplicates(["id"]) if repeated else texts, "texts")

    # First each set with the central one that it shares most keys with.
    a_side, b_side = (nodes.select(F.col("id").alias(p), F.col("n").alias(f"{p}_n"), *[F.col(s).alias(f"{p}{s}") for s in sig]) for p in "ab")
    near = (_distance("as", "bs") <= most) & (F.least("a_n", "b_n") * den >= F.greatest("a_n", "b_n") * num)
    met = placed.where("id <> hub").groupBy(F.col("id").alias("a"), F.col("hub").alias("b")).agg(F.count(F.lit(1)).alias("shared"))
    best = met.groupBy("a").agg(F.max_by("b", F.struct("shared", "b")).alias("b"))
    best = scratch.save(best.join(b_side, "b").join(a_side, "a").where(near).select("a", "b"), "best")
    texts = texts_of(best)
    links = scratch.save(_confirmed(best, texts, width, num, den), "links")
    scratch.drop(best, texts)
    same = known.join(classes.select("f1", "f2", "id"), ["f1", "f2"]).groupBy("doc_id").agg(F.min("id").alias("b"), F.max("id").alias("a")).where("a <> b")
    links = scratch.save(links.unionByName(same.select("a", "b")), "links")  # rows with one doc_id and several texts
    labels = scratch.save(components(links, scratch), "labels")

    def mixed(labels: DataFrame) -> DataFrame:
        """(a, b): sets and hubs of buckets that hold several components."""
        told = placed.join(labels, "id", "left").withColumn("c", F.coalesce("component", "id"))
        several = told.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("key").hint("merge")
        return scratch.save(told.join(several, "key", "left_semi").where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct(), "mixed")

    # Then, in buckets that still hold several components, all sets with their hubs, and with others by what differs from the hub.
    pairs = mixed(labels)
    texts = texts_of(pairs)
    diffs = scratch.save(_differences(pairs, texts, width), "diffs")
    scratch.drop(placed, pairs, texts)
    star = diffs.where(F.size("items") * (den + num) <= (F.col("n") + F.col("n_hub")) * (den - num)).select(F.col("id").alias("a"), F.col("hub").alias("b"))
    links = scratch.save(links.unionByName(star), "links")
    labels = scratch.save(components(links, scratch), "labels")
    more = scratch.save(_across(diffs, labels, scratch, num, den), "links")
    if more.take(1):
        links = scratch.save(links.unionByName(more), "links")
        labels = scratch.save(components(links, scratch), "labels")

    # Only classes of several rows or with links need to be told their component.
    told = classes.join(labels, "id", "left").where("rows > 1 OR component IS NOT NULL OR id <> doc_id").withColumn("component", F.coalesce("component", "id"))
    if unnamed:  # the smallest id of a component need not be a doc_id then
        told = told.join(told.groupBy("component").agg(F.min("doc_id").alias("least")).hint("merge"), "component").withColumn("component", F.col("least"))
    told = told.select("f1", "f2", "component")
    told = scratch.save(told, "told")
    out = feats.select("doc_id", "n", "f1", "f2").join(told, ["f1", "f2"], "left")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component")), F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op7_minhash_hamming(spark, sf_dir):
    return near_duplicates(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), width=3, num=85, den=100)


OP7_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
g AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM t),
x AS (SELECT doc_id, unnest(s) AS sh FROM g),
n AS (SELECT doc_id, len(s) AS n FROM g),
rare AS (SELECT sh FROM x GROUP BY sh HAVING count(*) > 1),
y AS (SELECT x.* FROM x JOIN rare USING (sh)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM y a JOIN y b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 85 * (na.n + nb.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, reach) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT e.b, r.reach FROM r JOIN e ON e.a = r.doc_id WHERE r.reach < e.b)
SELECT n.doc_id, n.n AS n_shingles, min(r.reach) AS component_id, min(r.reach) = n.doc_id AS kept
FROM n JOIN r ON r.doc_id = n.doc_id GROUP BY n.doc_id, n.n
"""
