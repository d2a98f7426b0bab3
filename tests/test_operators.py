"""Record linkage, point-in-time joins, closures, mentions, and values that are unknown, null or absent."""

import datetime
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tenderlake.operators import assemble, bidding, dedupe, documents, lineage, linkage, metrics
from tenderlake.operators.asof import as_of

VENDOR = "entity string, name string, place int, tax_id string"


# ---- vendor identities ----


def test_names_keep_letters_of_all_scripts(spark):
    rows = {"L.L.C. Bau GmbH & Co. KG": "llc bau", "Æther Works 北京": "æther works 北京", "Summit Glass, Limited": "summit glass", "SUMMIT GLASS Corporation": "summit glass", "Inc.": "", "Co-op Foods Inc": "co op foods", "Customer First LLC": "customer first", "Ünïted  Steel  S.A.": "ünïted steel", "": ""}
    got = spark.createDataFrame(list(rows.items()), "n string, want string").select("want", dedupe.normalized_name(F.col("n")).alias("got")).collect()
    assert all(r["want"] == r["got"] for r in got), got


UNRELATED = [("a1", "北京建筑", 1), ("a2", "上海建筑", 1), ("b1", None, 2), ("b2", None, 2), ("b3", "", 2), ("b4", "", 2), ("c1", "Customer First LLC", 3), ("c2", "Supplier First LLC", 3), ("d1", "Æther Works 北京", 4), ("d2", "ther Works", 4), ("e1", "Inc.", 5), ("e2", "Ltd", 5), ("f1", "Lonely Valley", None), ("f2", "Lonely Valley", None), ("g1", "Route 66 Supply", 6), ("g2", "Route 67 Supply", 6)]


def test_unrelated_companies_are_never_merged(spark):
    rows = UNRELATED + UNRELATED[:4]
    df = spark.createDataFrame(rows, "entity string, name string, place int")
    review = {"f1", "f2"}
    for got in (dedupe.resolve_identities(df).collect(), dedupe.resolve_vendors(df.withColumn("tax_id", F.lit(None).cast("string"))).collect(), linkage.resolve(df.withColumn("tax_id", F.lit(None).cast("string"))).collect()):
        assert sorted((r["entity"], r["resolved"], r["n_aliases"], r["verdict"]) for r in got) == sorted((e, e, 1, "review" if e in review else "single") for e, *_ in UNRELATED)


def test_repeated_records_are_no_aliases(spark):
    df = spark.createDataFrame([("x", "Harbour Works", 1, None)] * 3 + [("y", "Harbour Works Ltd.", 1, None)], VENDOR)
    for got in (dedupe.resolve_identities(df), dedupe.resolve_vendors(df), linkage.resolve(df)):
        assert sorted((r["entity"], r["resolved"], r["n_aliases"], r["verdict"]) for r in got.collect()) == [("x", "x", 2, "resolved"), ("y", "x", 2, "resolved")]


def planted(n=150, seed=7):
    """Vendors with some aliases each: (records, vendor of each entity)."""
    rng = random.Random(seed)
    first, second, third = "Northern Harbour Granite Silver Eastern Union Valley Summit Copper Meadow Falcon Juniper".split(), "Bridge Paving Electric Timber Water Survey Glass Steel Window Garden Roofing Signal".split(), "Works Partners Group Services Supply Builders".split()
    names = rng.sample([" ".join(x) for x in itertools.product(first, second, third)], n)
    rows, owner = [], {}
    for v, name in enumerate(names):
        place, tax = rng.randrange(12), f"T{v}" if rng.random() < 0.6 else None
        forms = [(name, place, tax)]
        if rng.random() < 0.5:
            forms.append((name.upper() + ", Inc.", place, None))
        if rng.random() < 0.4:
            at = rng.randrange(2, len(name) - 2)
            forms.append((name[:at] + name[at + 1 :], place, None))
        if tax and rng.random() < 0.5:
            forms.append((rng.choice(first) + " Holdings", rng.randrange(12), tax))
        for k, (x, p, t) in enumerate(forms):
            owner[f"v{v:03}-{k}"] = v
            rows.append((f"v{v:03}-{k}", x, p, t))
    return rows, owner


def test_linkage_finds_planted_aliases(spark):
    rows, owner = planted()
    got = linkage.resolve(spark.createDataFrame(rows, VENDOR)).collect()
    assert len(got) == len(rows)
    groups = {}
    for r in got:
        groups.setdefault(r["resolved"], set()).add(r["entity"])
    found = {p for g in groups.values() for p in itertools.combinations(sorted(g), 2)}
    true = {p for p in itertools.combinations(sorted(owner), 2) if owner[p[0]] == owner[p[1]]}
    assert len(true) > 100 and len(found & true) / len(found) >= 0.99 and len(found & true) / len(true) >= 0.9
    assert all(r["score"] is not None and r["reason"] for r in got if r["n_aliases"] > 1)
    assert all((r["n_aliases"] > 1) == (r["verdict"] == "resolved") for r in got)


def test_contradictions_are_not_merged(spark):
    """One record's name lies between two of different tax ids."""
    rows, _ = planted(60)
    rows += [("z1", "Summit Glass Group", 4, "X2"), ("z2", "Summit Glas Group", 4, None), ("z3", "Summit Gla Group", 4, "X3"), ("z4", "Elsewhere Named", 9, "X2")]
    got = {r["entity"]: (r["resolved"], r["verdict"]) for r in linkage.resolve(spark.createDataFrame(rows, VENDOR)).collect()}
    assert got["z1"][0] == got["z4"][0] == "z1" and got["z1"][0] != got["z3"][0]
    assert got["z2"] == ("z2", "review") or got["z2"][0] != got["z3"][0] or got["z2"][0] != got["z1"][0]


def test_em_against_a_direct_computation_over_pairs():
    rng = random.Random(1)
    pairs = [(rng.choice((2, 1, 0)), rng.choice((1, 0, -1)), rng.choice((1, 0, -1, -1))) for _ in range(500)]
    other = {"name": (0.01, 0.02, 0.97), "place": (0.1, 0.9), "tax": (0.001, 0.999)}
    counts = {p: pairs.count(p) for p in set(pairs)}
    model = linkage.expectation_maximisation([(*p, n) for p, n in counts.items()], other, 100)
    same, share = {f: list(v) for f, v in linkage.START.items()}, linkage.SHARE
    for _ in range(linkage.ITERATIONS):
        odds = []
        for p in pairs:
            yes, no = share, 1 - share
            for f, x in zip(linkage.LEVELS, p, strict=True):
                if x >= 0:
                    yes *= same[f][linkage.LEVELS[f].index(x)]
                    no *= other[f][linkage.LEVELS[f].index(x)]
            odds.append(yes / (yes + no))
        for k, f in enumerate(linkage.LEVELS):
            sums = [linkage.SMOOTH + sum(o for o, p in zip(odds, pairs, strict=True) if p[k] == x) for x in linkage.LEVELS[f]]
            same[f] = [s / sum(sums) for s in sums]
        share = (sum(odds) + linkage.SMOOTH) / (len(pairs) + 2 * linkage.SMOOTH)
    assert model.share == pytest.approx(share)
    assert all(model.same[f] == pytest.approx(tuple(same[f])) for f in same)
    assert linkage.expectation_maximisation([], other, 0).same == linkage.START


def test_candidates_of_a_hot_name_grow_with_its_records(spark):
    """A name that stands in very many places and with many tax ids."""
    made = {}
    for n in (100, 200):
        rows = [(f"p{i:04}", "Common Works", i, None) for i in range(n)] + [(f"t{i:04}", "Common Works", 0, f"T{i}") for i in range(n)] + [(f"s{i:04}", f"Other {i}", i, "T0") for i in range(n)]
        classes = linkage.classes_of(spark.createDataFrame(rows, VENDOR))
        made[n] = linkage.candidates(classes).count()
    assert made[200] <= 2.1 * made[100]


def test_linkage_of_an_empty_table(spark):
    assert linkage.resolve(spark.createDataFrame([], VENDOR)).count() == 0


# ---- point in time ----

DAY = datetime.datetime(2020, 1, 1)


@pytest.mark.parametrize("bin_days", [1, 30, 10_000])
def test_as_of_against_brute_force(spark, bin_days):
    rng = random.Random(4)
    key = lambda: 1 if rng.random() < 0.34 else rng.choice([2, 3, 4, 5, None])  # noqa: E731  one key holds a third of all rows
    when = lambda: None if rng.random() < 0.03 else DAY + datetime.timedelta(days=rng.randrange(200), hours=rng.choice([0, 0, 5]))
    left = [(i, key(), when()) for i in range(150)] + [(0, 1, DAY), (0, 1, DAY)]
    right = [(i, key(), when(), rng.choice([1.5, 2.0, None])) for i in range(200)]
    a, b = spark.createDataFrame(left, "id long, k long, t timestamp"), spark.createDataFrame(right, "r long, k long, t timestamp, v double")
    got = as_of(a, b, ["k"], "t", ["r"], {"last_r": F.col("r"), "last_v": F.col("v")}, {"n": F.lit(1).cast("long"), "total": F.col("v")}, bin_days).collect()
    want = []
    for i, k, t in left:
        if k is None or t is None:
            want.append((i, k, t, None, None, None, None))
            continue
        old = sorted((u, r, v) for r, k2, u, v in right if k2 == k and u is not None and u < t)
        want.append((i, k, t, *(old[-1][1:] if old else (None, None)), len(old), sum((v or 0.0 for *_, v in old), 0.0)))
    text = lambda rows: sorted(map(str, (tuple(r) for r in rows)))
    assert text(got) == text(want)
    assert as_of(a.limit(0), b, ["k"], "t", ["r"], {"x": F.col("r")}, {}).count() == 0
    bare = as_of(a, b.limit(0), ["k"], "t", ["r"], {"x": F.col("r")}, {"n": F.lit(1).cast("long")}).where("k IS NOT NULL AND t IS NOT NULL")
    assert {(r["x"], r["n"]) for r in bare.collect()} == {(None, 0)}


@pytest.mark.parametrize("hot", [0, 10**6])
def test_as_of_shuffles_once_unless_a_key_is_hot(spark, hot):
    t = lambda d: DAY + datetime.timedelta(days=d)
    a = spark.createDataFrame([(i, 1, t(40 * i)) for i in range(4)], "i long, k long, t timestamp")
    b = spark.createDataFrame([(i, 1, t(40 * i)) for i in range(4)], "r long, k long, t timestamp")
    got = as_of(a, b, ["k"], "t", ["r"], {"last": F.col("r")}, {"n": F.lit(1).cast("long")}, 30, hot)
    assert sorted((r["i"], r["last"], r["n"]) for r in got.collect()) == [(0, None, 0), (1, 0, 1), (2, 1, 2), (3, 2, 3)]
    assert ("Join" in got._jdf.queryExecution().executedPlan().toString()) == (hot == 0)


def test_features_use_nothing_of_the_day_itself(spark):
    t = lambda d: DAY + datetime.timedelta(days=d)
    rows = [(1, 7, 1, t(0), True), (1, 8, 1, t(0), False), (2, 7, 1, t(5), False), (2, 8, 1, t(5), True), (3, 7, 2, t(9), True), (4, 7, 1, t(9), True)]
    got = {(r["event"], r["vendor"]): r for r in bidding.features_at_bids(spark.createDataFrame(rows, "event long, vendor long, buyer long, date timestamp, won boolean")).collect()}
    told = lambda *k: tuple(got[k][c] for c in ("vendor_bids", "vendor_wins", "pair_bids", "pair_wins", "incumbent", "is_incumbent", "pair_idle_days"))
    assert told(1, 7) == (0, 0, 0, 0, None, None, None)
    assert told(2, 7) == (1, 1, 1, 1, 7, True, 5) and told(2, 8) == (1, 0, 1, 0, 7, False, 5)
    assert told(3, 7) == (2, 1, 0, 0, None, None, None) and told(4, 7) == (2, 1, 2, 1, 8, False, 4)


# ---- lineage ----


def test_orphans_stay_with_a_flag(spark):
    rows = [(1, None), (2, 1), (3, 99), (4, 3), (5, 4), (None, 1)]
    df = spark.createDataFrame(rows, "node long, parent long")
    assert {tuple(r) for r in lineage.chains(df, orphan="lost").collect()} == {(1, 1, 0, False), (2, 1, 1, False), (3, 3, 0, True), (4, 3, 1, True), (5, 3, 2, True)}
    assert {tuple(r) for r in lineage.chains(df).collect()} == {(1, 1, 0), (2, 1, 1), (3, 3, 0), (4, 3, 1), (5, 3, 2)}


def test_closure_of_several_predecessors(spark):
    rng = random.Random(6)
    edges = {(b, a): rng.choice([0.5, 0.75, 1.0]) for a, b in itertools.combinations(range(25), 2) if rng.random() < 0.15}
    edges |= {(50 + i, 49 + i): 1.0 for i in range(1, 12)} | {(1, 98): 0.5}
    rows = [(*k, c) for k, c in edges.items()] + [(2, 1, None), (None, 1, 0.5), (3, None, 0.5), *[(*k, 0.25) for k in list(edges)[:3]]]
    got = {(r["node"], r["ancestor"]): (r["confidence"], r["hops"], r["known"]) for r in lineage.closure(spark.createDataFrame(rows, "node long, parent long, confidence double")).collect()}
    best = {k: (c, -1) for k, c in edges.items()}
    changed = True
    while changed:
        changed = False
        for (n, a), (c, h) in list(best.items()):
            for (m, b), c2 in edges.items():
                if m == a and best.get((n, b), (-1, 0)) < (round(c * c2, 9), h - 1):
                    best[n, b] = (round(c * c2, 9), h - 1)
                    changed = True
    nodes = {n for n, _ in edges}
    assert got == {k: (c, -h, k[1] in nodes) for k, (c, h) in best.items()}
    assert max(h for _, h, _ in got.values()) >= 11


def test_closure_of_a_cycle_ends_and_shows_it(spark):
    df = spark.createDataFrame([(1, 2, 1.0), (2, 3, 0.5), (3, 1, 1.0), (4, 1, 1.0)], "node long, parent long, confidence double")
    got = {(r["node"], r["ancestor"]): r["confidence"] for r in lineage.closure(df).collect()}
    assert {n for n, a in got if n == a} == {1, 2, 3} and got[4, 3] == 0.5
    assert lineage.closure(df.limit(0)).count() == 0


# ---- documents ----


@pytest.mark.parametrize("most", [1 << 20, 12])
def test_mentions_of_overlapping_patterns(spark, most):
    pages = [(1, 1, "See RFP-12 and rfp-1, RFP-123; the Harbour Harbour works"), (1, 2, None), (2, 1, ""), (3, 1, "harbourHarbour rfp-12"), (3, 1, "harbourHarbour rfp-12"), (4, 1, "ünï RFP-1ü 😀 RFP-1")]
    known = [(10, "RFP-1"), (11, "RFP-12"), (12, "harbour"), (13, "Harbour Works"), (14, "HARBOUR"), (15, None), (16, ""), (10, "rfp-1")]
    df = spark.createDataFrame(pages, "doc long, page long, text string")
    got = documents.mentions(df, ["doc", "page"], "text", spark.createDataFrame(known, "id long, name string"), "id", "name", most).collect()
    want = []
    for d, p, t in pages:
        low = (t or "").lower()
        for i, name in {(i, n.lower()) for i, n in known if n}:
            for at in range(len(low)):
                if low.startswith(name, at) and not (at and low[at - 1].isalnum()) and not low[at + len(name) : at + len(name) + 1].isalnum():
                    want.append((d, p, at + 1, i, name))
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 8
    loose = documents.mentions(df, ["doc", "page"], "text", spark.createDataFrame(known, "id long, name string"), "id", "name", most, whole=False)
    assert loose.count() > len(want)
    assert documents.mentions(df.limit(0), ["doc", "page"], "text", spark.createDataFrame(known, "id long, name string").limit(0), "id", "name").count() == 0


def test_a_document_without_text_stays(spark):
    df = spark.createDataFrame([(1, "a\nb"), (2, None), (3, "")], "id long, text string")
    assert {tuple(r) for r in documents.page_texts(df, "id", "text").collect()} == {(1, 1, "a"), (1, 2, "b"), (2, None, None), (3, 1, "")}


def test_claims_cite_pages(spark):
    pages = documents.page_texts(spark.createDataFrame([(1, "a\nb")], "id long, text string"), "id", "text")
    claims = spark.createDataFrame([(1, 2), (1, 3), (2, 1), (1, None)], "id long, page_no long")
    assert {(r["id"], r["page_no"], r["cited"]) for r in documents.cited(claims, pages, ["id", "page_no"]).collect()} == {(1, 2, True), (1, 3, False), (2, 1, False), (1, None, False)}


# ---- unknown values ----


def test_a_null_vendor_keeps_its_profile(spark):
    rows = [(None, 1, True, 5.0, DAY, "X"), (None, 2, False, 7.0, DAY, "Y"), (3, 1, False, None, DAY, None)]
    got = {r["vendor"]: r for r in bidding.vendor_profiles(spark.createDataFrame(rows, "vendor long, buyer long, won boolean, amount double, date timestamp, category string")).collect()}
    assert (got[None]["typical_amount"], got[None]["categories"], got[None]["n_bids"]) == (6.0, "X,Y", 2)
    assert (got[3]["typical_amount"], got[3]["categories"], got[3]["won_value"]) == (None, "", None)


def test_medians_of_odd_values(spark):
    import statistics

    rng = random.Random(9)
    rows = [(1, rng.gauss(0, 1e6)) for _ in range(3001)] + [(2, 4.0)] * 10 + [(3, x) for x in (1.0, 2.0, 1e12, 3.0)] + [(None, 1.0), (None, 8.0), (5, math.inf), (5, 1.0), (5, 2.0)]
    got = dict(bidding.exact_median(spark.createDataFrame(rows, "k long, x double"), "k", "x", "m").collect())
    assert got == {k: statistics.median(x for j, x in rows if j == k) for k in (1, 2, 3, None, 5)}


def test_shares_of_nothing_are_unknown(spark):
    assert [tuple(r) for r in metrics.completeness(spark.createDataFrame([], "a long, b long"), ["a", "b"]).collect()] == [("a", 0, 0, None), ("b", 0, 0, None)]
    got = bidding.intensity(spark.createDataFrame([(1, 7, 0.0), (1, 8, 0.0), (2, 7, 3.0)], "event long, vendor long, amount double")).collect()
    assert {tuple(r) for r in got} == {(1, 2, None), (2, 1, 1.0)}


def test_an_absent_side_is_no_conflict(spark):
    portal = spark.createDataFrame([(1, 5.0, 1), (2, 5.0, 1), (None, 5.0, 1), (4, None, 1)], "k long, v double, t long")
    document = spark.createDataFrame([(1, 6.0, 2), (3, 5.0, 1), (None, 5.0, 3), (4, 2.0, 0)], "k long, v double, t long")
    got = {r["k"]: (r["conflict"], r["controlling"]) for r in assemble.conflicts(portal, document, ["k"], "v", ["t"]).collect()}
    assert got == {1: (True, 6.0), 2: (None, 5.0), 3: (None, 5.0), None: (False, 5.0), 4: (None, None)}


# ---- differences ----


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            row[j], last = (last + 1 if x == y else max(row[j], row[j - 1])), row[j]
    return row[-1]


def checked(old, new, found):
    """The runs, in order, put both texts together, and keep as many words as any common subsequence."""
    assert [r["run"] for r in found] == list(range(len(found)))
    at_old = at_new = kept = 0
    for r, after in itertools.zip_longest(found, found[1:]):
        assert (r["old_from"], r["new_from"]) == (at_old, at_new) and (after is None or after["change"] != r["change"])
        at_old, at_new = r["old_to"], r["new_to"]
        if r["change"] == "kept":
            assert old[r["old_from"] : at_old] == new[r["new_from"] : at_new]
            kept += at_old - r["old_from"]
        else:
            assert r["change"] == ("deleted" if at_old > r["old_from"] else "inserted") and (at_old > r["old_from"]) != (at_new > r["new_from"])
    assert (at_old, at_new) == (len(old), len(new)) and kept == lcs_length(old, new)


def test_runs_against_brute_force_lengths(spark):
    from tenderlake.operators.differences import LINES, text_changes

    rng = random.Random(8)
    texts = {0: None, 1: "", 2: "a b", 3: "  b\ta \n", 4: "a\nb\nc"}
    for i in range(5, 60):
        words = [rng.choice("abcdefg") for _ in range(rng.randrange(40))]
        texts[i] = " ".join(words)
    base = [f"w{rng.randrange(300)}" for _ in range(900)]
    texts |= {60: " ".join(base), 61: " ".join(w for w in base if rng.random() < 0.9), 62: " ".join(base[:400] + ["x", "y"] + base[395:])}
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(120)] + [(60, 61), (60, 62), (61, 60), (60, 60), (0, 1), (0, 2), (2, 0), (2, 3), (2, 3), (5, 999)]
    df = spark.createDataFrame(list(texts.items()), "id long, text string")
    got = {}
    for r in text_changes(spark.createDataFrame(pairs, "old long, new long"), df, "id", "text").collect():
        got.setdefault((r["old"], r["new"]), []).append(r)
    words = {i: (t or "").split() for i, t in texts.items()}
    for a, b in set(pairs):
        if (a, b) != (5, 999):
            found = sorted(got.get((a, b), []), key=lambda r: r["run"])
            checked(words[a], words[b], found) if found else None
            assert bool(found) == bool(words[a] or words[b])
            assert all(r["said"] == " ".join(words[a][r["old_from"] : r["old_to"]] if r["change"] == "deleted" else words[b][r["new_from"] : r["new_to"]]) for r in found)
    assert (5, 999) not in got
    lines = text_changes(spark.createDataFrame([(4, 2)], "old long, new long"), df, "id", "text", LINES).collect()
    assert sorted((r["change"], r["said"]) for r in lines) == [("deleted", "a b c"), ("inserted", "a b")]


def test_text_changes_of_near_copies(spark):
    from tenderlake.plans.registry import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r[0]: (r[1] or "").split() for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    pairs = {(r["id_a"], r["id_b"]) for r in QUERIES["s02_fuzzy_duplicates"](spark, sf).collect()}
    got = {}
    for r in QUERIES["s48_text_changes"](spark, sf).collect():
        got.setdefault((r["old"], r["new"]), []).append(r)
    assert got.keys() == pairs and pairs
    for (a, b), found in list(got.items())[:15]:
        checked(texts[a], texts[b], sorted(found, key=lambda r: r["run"]))


# ---- predictions ----


def history(spark, n=240, seed=3):
    """Buyers 0 to 5 each have two vendors that bid for them again and again, and now and then another one."""
    rng = random.Random(seed)
    rows = []
    for e in range(n):
        buyer = rng.randrange(6)
        vendors = {2 * buyer, 2 * buyer + 1} | {rng.randrange(40) for _ in range(rng.random() < 0.5)}
        amounts = {v: 1000.0 * (1 + v % 3) * rng.uniform(0.9, 1.1) for v in vendors}
        best = min(amounts, key=amounts.get)
        rows += [(e, v, buyer, f"c{buyer % 3}", x, DAY + datetime.timedelta(days=3 * e), v == best) for v, x in amounts.items()]
    return spark.createDataFrame(rows, "event long, vendor long, buyer long, category string, amount double, date timestamp, won boolean")


def test_model_ranks_habitual_bidders_first_and_is_calibrated(spark):
    from tenderlake.operators import prediction

    bids = history(spark).cache()
    cutoff = str(DAY + datetime.timedelta(days=3 * 180))
    old = bids.where(F.col("date") < F.lit(cutoff).cast("timestamp"))
    pairs = prediction.candidate_features(prediction.training_pairs(old), old).cache()
    labels = {r["label"]: r["count"] for r in pairs.groupBy("label").count().collect()}
    assert labels[1.0] == old.count() and labels[0.0] > labels[1.0]
    model = prediction.fit(pairs)
    held = prediction.events_of(bids.where(F.col("date") >= F.lit(cutoff).cast("timestamp")))
    got = prediction.predicted_bidders(model, held, bids, cutoff).collect()
    buyers = {r["event"]: r["buyer"] for r in held.collect()}
    first = {e: {r["vendor"] for r in got if r["event"] == e and r["place"] <= 2} for e in buyers}
    assert sum(len(first[e] & {2 * b, 2 * b + 1}) for e, b in buyers.items()) >= 1.8 * len(buyers)
    for r in got:
        assert 0 <= r["probability"] <= 1 and r["confident"] == (r["probability"] >= prediction.CONFIDENT)
        assert r["raw_score"] == pytest.approx(model.intercept + sum(c["value"] for c in r["contributions"])) and {c["name"] for c in r["contributions"]} == set(prediction.FEATURES)
    told = model.score(pairs).agg(F.avg("probability"), F.avg("label")).first()
    assert abs(told[0] - told[1]) < 0.1
    assert model.values == sorted(model.values)


def test_weights_of_a_closed_case(spark):
    """With one feature of two values, log-odds are those of the counts."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    from tenderlake.operators import prediction

    rows = [(e, *[float(x)] * 1, *[0.0] * 9, float(y)) for e, (x, y) in enumerate([(1, 1)] * 60 + [(1, 0)] * 20 + [(0, 1)] * 10 + [(0, 0)] * 90)]
    df = spark.createDataFrame(rows, "event long, " + ", ".join(f"{f} double" for f in prediction.FEATURES) + ", label double")
    found = LogisticRegression(featuresCol="x", labelCol="label", regParam=0.0, maxIter=100, tol=1e-10).fit(VectorAssembler(inputCols=list(prediction.FEATURES), outputCol="x").transform(df))
    assert found.intercept == pytest.approx(math.log(10 / 90), abs=1e-3) and found.coefficients[0] == pytest.approx(math.log(60 / 20) - math.log(10 / 90), abs=1e-3)
    model = prediction.Model({**dict.fromkeys(prediction.FEATURES, 0.0), prediction.FEATURES[0]: float(found.coefficients[0])}, float(found.intercept), [], [])
    told = {r["pair_bids"]: r["p"] for r in prediction.calibrate(model, df).score(df).groupBy("pair_bids").agg(F.avg("probability").alias("p")).collect()}
    assert told[1.0] == pytest.approx(0.75) and told[0.0] == pytest.approx(0.1)
    none = prediction.fit(df.where("label = 1"))
    assert none.intercept == 0 and set(none.weights.values()) == {0.0} and none.score(df).first()["probability"] == 0.5


def test_pool_adjacent_violators(spark):
    """Against the definition: the least-squares fit among all that never fall."""
    from tenderlake.operators import prediction

    rng = random.Random(2)
    rows = [(i, float(i), *[0.0] * 9, float(rng.random() < i / 40)) for i in range(40)]
    df = spark.createDataFrame(rows, "event long, " + ", ".join(f"{f} double" for f in prediction.FEATURES) + ", label double")
    model = prediction.calibrate(prediction.Model({**dict.fromkeys(prediction.FEATURES, 0.0), prediction.FEATURES[0]: 1.0}, 0.0, [], []), df)
    blocks = []
    for *_, y in rows:
        blocks.append([y, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] > blocks[-1][0] * blocks[-2][1]:
            total, n = blocks.pop()
            blocks[-1] = [blocks[-1][0] + total, blocks[-1][1] + n]
    want = [t / n for t, n in blocks for _ in range(n)]
    got = [r[0] for r in model.score(df).orderBy("event").select("probability").collect()]
    assert max(abs(g - w) for g, w in zip(got, want, strict=True)) < 0.26 and got == sorted(got)


def test_predictions_without_history(spark):
    from tenderlake.operators import prediction

    bids = history(spark, 12)
    early = prediction.events_of(bids)
    assert prediction.predicted_bidders(prediction.Model(dict.fromkeys(prediction.FEATURES, 0.0), 0.0, [], []), early, bids, "2019-01-01").count() == 0
    assert prediction.training_pairs(bids.limit(0)).count() == 0


def test_features_after_all_bids_are_those_of_the_as_of_joins(spark):
    """Also of events without a buyer, category or amount; no candidate is put in order with all bids, as as-of joins do."""
    from pyspark.sql.window import Window

    from tenderlake.operators import prediction
    from tenderlake.plans import registry

    b = registry.awarded(spark, "/root/testdata/sf0.001").drop("line", "commodity")
    cutoff = F.lit("1997-01-01").cast("timestamp")
    old, e = b.where(F.col("date") < cutoff), F.col("event")
    held = prediction.events_of(b.where(F.col("date") >= cutoff))
    held = held.withColumns({"buyer": F.when(e % 11 != 0, F.col("buyer")), "category": F.when(e % 7 != 0, F.col("category")), "amount": F.when(e % 5 != 0, F.col("amount"))}).localCheckpoint()
    old = old.withColumn("amount", F.when(e % 3 != 0, F.col("amount"))).localCheckpoint()
    pool, lists = 4, []
    for by in ("buyer", "category"):
        n = old.where(F.col(by).isNotNull()).groupBy(by, "vendor").count()
        n = n.withColumn("r", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("count"), "vendor"))).where(F.col("r") <= pool)
        lists.append(held.join(n.select(by, "vendor"), by).select(*held.columns, "vendor"))
    told = lambda df: {(r.event, r.vendor): [round(x, 9) for x in r[2:]] for r in df.collect()}
    found = prediction.features_after(held, old, pool).localCheckpoint()
    want = prediction.candidate_features(lists[0].unionByName(lists[1]).distinct(), old).select("event", "vendor", *prediction.FEATURES)
    assert found.count() == want.count() > 500 and told(found) == told(want)
    model = prediction.Model(dict.fromkeys(prediction.FEATURES, 0.1), 0.0, [], [])
    plan = prediction.predicted_bidders(model, held, old, "1997-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "_side" not in plan


def shuffled(spark):
    """Bytes of the shuffles on disk."""
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    files = [files.apply(i) for i in range(files.size())]
    return sum(f.length() for f in files if f.getName().startswith("shuffle_") and f.getName().endswith(".data"))


def test_each_as_of_join_of_predictions_is_written_and_its_shuffle_goes(spark):
    from tenderlake.operators import prediction
    from tenderlake.session import Scratch

    bids = history(spark, 60)
    plan = prediction.candidate_features(prediction.training_pairs(bids), bids)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    left = []
    for kept in (True, False):
        before = shuffled(spark)
        Scratch(spark, "t", kept=kept).save(bids.groupBy("vendor").count())
        left.append(shuffled(spark) - before)
    assert left[0] > 0 == left[1]


def test_precision_of_the_model_stores_its_bids_once(spark, monkeypatch):
    from tenderlake.operators import prediction
    from tenderlake.plans import registry

    names, save = [], registry.Scratch.save
    monkeypatch.setattr(registry.Scratch, "save", lambda self, df, name="t", **more: (names.append(name), save(self, df, name, **more))[1])
    monkeypatch.setattr(prediction, "fit", lambda pairs: prediction.Model(dict.fromkeys(prediction.FEATURES, 0.1), 0.0, [], []))
    got = {r["way"]: r["n_events"] for r in registry.QUERIES["s34_precision_of_model"](spark, "/root/testdata/sf0.001").collect()}
    assert names.count("bids") == 1 and got.keys() == {"model", "fixed_weights"} and len(set(got.values())) == 1


# ---- contracts, links, fetches, spend, gaps ----


def test_each_kind_of_breach(spark):
    from tenderlake.operators import contracts

    rows = [("a", "2020-01-01", 5, ["x", "y"], (1, "p"), "k1"), ("b", "2020-02-31", -1, ["x", None], (None, "q"), "zz"), ("a", "soon", 50, ["w", "w"], (2, None), None), (None, None, None, None, None, "k2")]
    df = spark.createDataFrame(rows, "id string, day string, n int, tags array<string>, inner struct<code: int, name: string>, other string")
    spec = {"t": {"key": ["id"], "columns": {"id": {"required": True}, "day": {"format": "date"}, "n": {"least": 0, "most": 10}, "tags[]": {"enum": ["x", "y"], "required": True}, "inner.code": {"required": True, "least": 2}, "inner.name": {"pattern": "[p-q]"}, "gone": {"required": True}, "gone.too": {}}, "unique": [["id"]], "references": [{"columns": ["other"], "table": "o", "to": ["k"]}]}}
    other = spark.createDataFrame([("k1",), ("k2",), ("k2",)], "k string")
    got = contracts.validate({"t": df, "o": other}, spec)
    want = [("a", "id", "unique"), ("a", "id", "unique"), ("null", "id", "required"), ("b", "day", "format"), ("a", "day", "format"), ("b", "n", "least"), ("a", "n", "most"), ("b", "tags[]", "required"), ("a", "tags[]", "enum"), ("a", "inner.code", "least"), ("b", "inner.code", "required"), ("null", "inner.code", "required"), ("b", "other", "reference"), (None, "gone", "missing_column"), (None, "gone.too", "missing_column")]
    assert sorted(map(str, ((r["key"], r["path"], r["rule"]) for r in got.collect()))) == sorted(map(str, want))
    assert {(r["path"], r["rule"], r["n"]) for r in contracts.report(got).collect()} >= {("id", "unique", 2), ("n", "most", 1)}
    assert contracts.validate({"t": df.limit(0).drop("gone"), "o": other}, spec).where("rule <> 'missing_column'").count() == 0
    with pytest.raises(ValueError, match="unknown rules: shape"):
        contracts.validate({"t": df, "o": other}, {"t": {"key": ["id"], "columns": {"id": {"shape": 1}}}})


def test_links_however_they_are_written(spark):
    html = """<a href="/a?x=1&amp;y=&quot;2&quot;">A</a><A HREF='/b'>b</A><a class=x href=/c>c</a><a href = "/d e">d</a><a data-href="/no"><a href="">"""
    got = documents.links(spark.createDataFrame([(1, html), (2, None), (3, "none")], "id long, html string"), "id", "html").orderBy("pos").collect()
    assert [r["href"] for r in got] == ['/a?x=1&y="2"', "/b", "/c", "/d e", ""] and [r["pos"] for r in got] == list(range(5))


def test_verdicts_of_fetches(spark):
    rows = [("<!DOCTYPE html> some text", 200, "text/html; charset=x"), ("<!doctype html>", 404, "text/html"), ("<!doctype html>", None, "text/html"), (None, 200, "text/html"), ("<!doctype html>", 200, "application/pdf"), ("<!doctype html>", 200, None), ("<!d", 200, "TEXT/HTML"), ("<html>" + "x" * 20, 200, "text/html"), ("<!doctype " + "x" * 90, 200, "text/html")]
    df = spark.createDataFrame(rows, "c string, s int, t string")
    got = [r[0] for r in df.select(documents.fetch_verdict(F.col("c"), 10, 50, "<!doctype", F.col("s"), F.col("t"))).collect()]
    assert got == ["ok", "bad_status", "bad_status", "missing", "bad_content_type", "bad_content_type", "too_small", "bad_signature", "too_large"]


def test_spend_of_null_agencies_and_quiet_years(spark):
    from tenderlake.operators import spend

    rows = [(1, 7, datetime.datetime(2020, 1, 5), 60.0), (1, 8, datetime.datetime(2020, 3, 5), 40.0), (1, 7, datetime.datetime(2022, 6, 1), 5.0), (None, 9, datetime.datetime(2022, 5, 1), 1.0), (2, None, None, 3.0)]
    sums = spend.monthly(spark.createDataFrame(rows, "agency long, vendor long, date timestamp, amount double"))
    got = {(r["agency"], r["month"] - 2020 * 12): tuple(r)[2:] for r in spend.trailing_years(sums).collect()}
    assert got[1, 0] == (60.0, 1, 1.0) and got[1, 2] == (100.0, 2, 0.52) and got[1, 12] == (40.0, 1, 1.0) and got[1, 20] == (0.0, 0, None) and got[1, 29] == (5.0, 1, 1.0)
    assert got[None, 28] == got[None, 29] == (1.0, 1, 1.0) and len(got) == 30 + 2
    told = {(r["level"], r["month"], r["agency"], r["vendor"]): r["spent"] for r in spend.rollup(sums).collect()}
    assert told["all", None, None, None] == 109.0 and told["agency", None, None, None] == 1.0 and told["month", None, None, None] == 3.0


def test_gaps_of_sources(spark):
    t = lambda d, h: datetime.datetime(2020, 1, d, h, 30)
    rows = [("a", t(1, 0)), ("a", t(1, 1)), ("a", t(1, 9)), ("a", t(1, 9)), ("b", t(2, 0)), ("a", None), (None, t(1, 5))]
    got = metrics.source_gaps(spark.createDataFrame(rows, "s string, ts timestamp"), "s", "ts", 5, "2020-01-02 03:00:00").collect()
    assert {(r["source"], r["gap_from"].hour, r["hours"], r["open"]) for r in got} == {("a", 1, 8, False), ("a", 9, 18, True), (None, 5, 22, True)}


# ---- imports ----


def test_imports_touch_only_what_they_bring(spark, tmp_path):
    from tenderlake.operators.merge import BUCKET, bucketed, merge

    rng = random.Random(5)
    path, schema = str(tmp_path / "t"), "k long, v string, t long"
    rows = [(rng.choice([*range(40), None]), f"v{i}", rng.randrange(20)) for i in range(300)]
    batches = [rows[:150], rows[100:250], rows[100:250], rows[250:], []]
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    seen = []
    for b in batches:
        before, df = (files() if seen else {}), spark.createDataFrame(b, schema)
        touched = {r[0] for r in bucketed(df, ["k"], 16).select(BUCKET).distinct().collect()}
        merge(spark, path, df, ["k"], ["t"], 16)
        seen += b
        want = {}
        for k, v, t in seen:
            want[k] = max(want.get(k, (-1, "")), (t, v))
        got = {r["k"]: (r["t"], r["v"]) for r in spark.read.parquet(path).collect()}
        assert got == want
        kept = {p: m for p, m in before.items() if int(p.parent.name.split("=")[1]) not in touched}
        assert kept.items() <= files().items()
    lone = next(k for k in range(40, 99))
    before = files()
    merge(spark, path, spark.createDataFrame([(lone, "x", 1)], schema), ["k"], ["t"], 16)
    assert sum(p not in files() for p in before) <= 1


def test_a_stream_of_imports_can_be_replayed(spark, tmp_path):
    from tenderlake.operators.merge import merging

    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (2, "c", 2)], "k long, v string, t long")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    for run in ("one", "two"):  # without the first one's checkpoint, all comes again
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        q = stream.writeStream.foreachBatch(merging(str(tmp_path / "t"), ["k"], ["t"], 4)).option("checkpointLocation", str(tmp_path / run)).trigger(availableNow=True).start()
        q.awaitTermination()
        assert {(r["k"], r["v"], r["t"]) for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {(1, "b", 3), (2, "c", 2)}


def test_order_of_imports_and_dense_ids(spark):
    from tenderlake.operators.merge import dense_ids, import_order
    from tenderlake.plans.exports import CONTRACTS

    order = import_order(CONTRACTS)
    assert sorted(order) == sorted(CONTRACTS)
    assert all(order.index(r["table"]) < order.index(n) for n, c in CONTRACTS.items() for r in c.get("references", []))
    with pytest.raises(ValueError):
        import_order({"a": {"references": [{"table": "b"}]}, "b": {"references": [{"table": "a"}]}})
    records = spark.range(500).select((F.col("id") * 7919 % 500).alias("k"), F.when(F.col("id") > 0, (F.col("id") - 1) * 7919 % 500).alias("parent"))
    got = dense_ids(records, ["k"], "n").collect()
    number = {r["k"]: r["n"] for r in got}
    assert [number[k] for k in sorted(number)] == list(range(1, 501))
    # References hold once both sides are renumbered.
    ids = spark.createDataFrame(list(number.items()), "k long, n long")
    met = records.join(ids, "k").join(ids.select(F.col("k").alias("parent"), F.col("n").alias("parent_n")), "parent", "left")
    assert met.where("parent IS NOT NULL AND parent_n IS NULL").count() == 0
    assert dense_ids(records.limit(0), ["k"], "n").count() == 0


def test_activity_of_vendors(spark):
    t = lambda d: DAY + datetime.timedelta(days=d)
    rows = [(1, 5, 3, t(0), True), (1, 5, 3, t(730), False), (1, 4, 10, t(9), False), (1, 4, None, t(9), False), (None, 7, 2, t(1), False), (2, None, None, t(1), True)]
    got = {r["vendor"]: tuple(r)[1:] for r in bidding.vendor_activity(spark.createDataFrame(rows, "vendor long, buyer long, place int, date timestamp, won boolean")).collect()}
    assert got[1] == (2.0, 2, 4, 0.5, "3,10", 0.25, "prime")
    assert got[None] == (1.0, 1, 7, 1.0, "2", 0.0, "bidder") and got[2] == (1.0, 0, None, None, "", 1.0, "prime")
