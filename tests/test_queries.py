"""Every registered query against its SQL on the smallest tables, and what the SQL can't show."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tenderlake.plans import registry
from tenderlake.plans.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def told(df):
    df = df[sorted(df.columns)].convert_dtypes().astype(str)
    return list(df.columns), sorted(map(tuple, df.itertuples(index=False)))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, db, name):
    assert told(QUERIES[name](spark, SF).toPandas()) == told(db.execute(SQL[name]).df())


def test_fuzzy_pairs_on_planted_copies(spark):
    from tenderlake.operators.dedupe import fuzzy_pairs

    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base), (2, base), (3, base + " more"), (4, base.replace("w30", "x")), (5, "short"), (6, None), (7, "")]
    got = {(r[0], r[1]) for r in fuzzy_pairs(spark.createDataFrame(rows, "id long, t string"), "id", "t").collect()}
    assert got == {(1, 3), (1, 4), (3, 4)}


def test_chain_of_a_cycle_free_graph(spark):
    from tenderlake.operators.lineage import chains

    edges = [(i, i - 1 if i else None) for i in range(40)]
    got = chains(spark.createDataFrame(edges, "node long, parent long")).collect()
    assert {(r["node"], r["root"], r["depth"]) for r in got} == {(i, 0, i) for i in range(40)}


def test_chains_of_any_length_reach_their_roots(spark):
    from tenderlake.operators.lineage import chains

    edges = [(i, i - 1 if i % 150 else None) for i in range(300)] + [(1000, None), (1001, 1000), (1002, 1000)]
    got = chains(spark.createDataFrame(edges, "node long, parent long")).collect()
    want = {(i, i - i % 150, i % 150) for i in range(300)} | {(1000, 1000, 0), (1001, 1000, 1), (1002, 1000, 1)}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    with pytest.raises(ValueError, match="cycle"):
        chains(spark.createDataFrame([(0, None), (1, 2), (2, 3), (3, 1)], "node long, parent long"))


def test_vendors_are_merged_by_evidence_and_never_across_tax_ids(spark):
    from tenderlake.operators.dedupe import resolve_vendors

    rows = [
        ("a1", "Harbour Paving Works", 1, "T1"), ("a2", "HARBOUR PAVING WORKS, Inc.", 1, None), ("a3", "Harbour Pavng Works", 1, None), ("a4", "Something Else", 9, "T1"),  # one vendor
        ("b1", "Harbour Paving Works", 2, None),  # the name alone: review
        ("c1", "Route 66 Supply", 3, None), ("c2", "Route 67 Supply", 3, None),  # other digits
        ("d1", "Summit Glass Group", 4, "T2"), ("d2", "Summit Glas Group", 4, None), ("d3", "Summit Gla Group", 4, "T3"),  # would join two tax ids
        ("e1", None, 5, None), ("e2", "", 5, None), ("e3", "Inc.", 5, None), ("f1", "Lonely Valley", None, None),
    ]
    df = spark.createDataFrame(rows, "entity string, name string, place int, tax_id string")
    got = {r["entity"]: (r["resolved"], r["n_aliases"], r["verdict"]) for r in resolve_vendors(df).collect()}
    assert len(got) == len(rows)
    assert {got[x] for x in ("a1", "a2", "a3", "a4")} == {("a1", 4, "resolved")}
    assert got["b1"] == ("b1", 1, "review") and got["c1"] == ("c1", 1, "single") and got["c2"] == ("c2", 1, "single")
    assert [got[x] for x in ("d1", "d2", "d3")] == [(x, 1, "review") for x in ("d1", "d2", "d3")]
    assert all(got[x] == (x, 1, "single") for x in ("e1", "e2", "e3", "f1"))
    assert resolve_vendors(df.limit(0)).count() == 0


def test_connected_nodes_of_long_chains(spark):
    from tenderlake.operators.dedupe import connected
    from tenderlake.session import Scratch

    edges = [(i, i + 1) for i in range(0, 130)] + [(200, 210), (205, 210), (300, 300)]
    got = dict(connected(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect())
    assert got == {**{i: 0 for i in range(131)}, 200: 200, 205: 200, 210: 200, 300: 300}


def test_links_by_several_keys_against_brute_force(spark):
    import datetime
    import random

    from tenderlake.operators.lineage import scored_links

    rng = random.Random(3)
    day = datetime.date(2020, 1, 1)
    rows = [(i, rng.choice([1, 2, 3, None]), rng.choice("xyz"), day + datetime.timedelta(rng.randrange(400))) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, k long, t string, d date")
    same = {c: F.col(f"a_{c}") == F.col(f"b_{c}") for c in ("k", "t")}
    got = scored_links(df, ["k", "t"], "id", "d", {"key": (2, same["k"]), "title": (1, same["t"])}, 2, 30).collect()
    want = set()
    for i, k, t, d in rows:
        for j, k2, t2, d2 in rows:
            score = 2 * (k is not None and k == k2) + (t == t2)
            if 0 < (d - d2).days <= 30 and score >= 2:
                want.add((i, j, score))
    assert {(r["record"], r["predecessor"], r["score"]) for r in got} == want and len(got) == len(want)


def test_exact_median(spark):
    import statistics

    from tenderlake.operators.bidding import exact_median

    rows = [(i % 5, float((i * 37) % 11)) for i in range(57)] + [(9, 2.0), (8, None), (7, 1.0), (7, 4.0)]
    got = dict(exact_median(spark.createDataFrame(rows, "k long, x double"), "k", "x", "m").collect())
    want = {k: statistics.median(x for j, x in rows if j == k and x is not None) for k in {0, 1, 2, 3, 4, 7, 9}}
    assert got == want


def test_similar_events_of_every_event(spark):
    from tenderlake.plans.registry import bids

    items = {}
    for r in bids(spark, SF).select("event", "commodity").distinct().collect():
        items.setdefault(r[0], set()).add(r[1])
    want = set()
    for e, own in items.items():
        met = sorted((-len(own & x) / len(own | x), o) for o, x in items.items() if o != e and own & x)
        want |= {(e, o, i + 1) for i, (_, o) in enumerate(met[:3])}
    got = QUERIES["s27_similar_events"](spark, SF).collect()
    assert {(r["event"], r["similar"], r["place"]) for r in got} == want and len(got) == len(want)


def test_fuzzy_pairs_send_back_only_shared_shingles(spark, monkeypatch):
    from tenderlake.operators import dedupe

    saved = {}
    save = dedupe.Scratch.save
    monkeypatch.setattr(dedupe.Scratch, "save", lambda self, df, name="t", **more: saved.setdefault(name, save(self, df, name, **more)))
    words = lambda k, n: [f"{k}w{i}" for i in range(n)]
    rows = [(i, " ".join(words(i, 60))) for i in range(5)] + [(9, " ".join([*words(0, 60), "end"])), (10, None), (11, "few words")]
    got = dedupe.fuzzy_pairs(spark.createDataFrame(rows, "id long, t string"), "id", "t").collect()
    assert [tuple(r) for r in got] == [(0, 9, 56, 57)]
    assert {r["id"]: (r["n"], len(r["held"])) for r in saved["held"].collect()} == {0: (56, 56), 9: (57, 56)}


def test_texts_without_near_copies_are_left_out_before_their_sets_are_compared(spark):
    """Pairs are those of brute force, also at the threshold, and a common passage alone brings no text further."""
    import random

    from tenderlake.operators import dedupe

    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(12))
    texts = {}
    for i in range(12):
        words = [f"d{i}w{j}" for j in range(rng.choice([6, 9, 20, 60, 140]))]
        texts[10 * i] = " ".join(words)
        for k in range(1, 6):
            other = list(words)
            for _ in range(rng.choice([1, 1, 1, 2, 3])):
                at = rng.randrange(len(other))
                other[at : at + rng.choice([0, 1])] = [f"new{rng.randrange(10**9)}"] * rng.choice([0, 1, 1, len(words) // 20])
            texts[10 * i + k] = " ".join(other)
    texts |= {1000 + i: " ".join([*[f"alone{i}w{j}" for j in range(80)], passage]) for i in range(6)}
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in texts.items())}
    first = {}
    for i in sorted(texts):
        first.setdefault(texts[i], i)
    want = {(a, b, len(sets[a] & sets[b]), len(sets[a] | sets[b])) for a in first.values() for b in first.values() if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    df = spark.createDataFrame(list(texts.items()), "id long, t string")
    assert {tuple(r) for r in dedupe.fuzzy_pairs(df, "id", "t").collect()} == want and len(want) > 30
    near = {r["id"] for r in dedupe.near_texts(df, "id", "t").collect()}
    assert near >= {i for p in want for i in p[:2]} and not near & set(range(1000, 1006)) and len(near) < len(texts)


def test_similar_events_of_hot_commodities_and_wide_events(spark, monkeypatch):
    import random

    from tenderlake.operators import bidding

    monkeypatch.setattr(bidding, "WIDE", 6)
    rng = random.Random(5)
    rows = {(e, c) for e in range(60) for c in [0, *rng.sample(range(1, 30), rng.randrange(1, 9))]} | {(70, 1), (71, None), (72, 1), (72, None)}
    items = {}
    for e, c in rows:
        items.setdefault(e, set()).add(c)
    df = spark.createDataFrame(sorted(rows, key=str), "event long, commodity long")
    want = set()
    for e, own in items.items():
        met = [(len((own & x) - {None}), len(own | x) + (None in own & x), o) for o, x in items.items() if o != e and (own & x) - {None}]
        for place, (k, either, o) in enumerate(sorted(met, key=lambda m: (-m[0] / m[1], m[2]))[:3], 1):
            want.add((e, o, k, either, place))
    got = bidding.similar_events(df, df.where("event % 2 = 0"))
    assert {tuple(r) for r in got.collect()} == {w for w in want if w[0] % 2 == 0}
    # A commodity of all events pairs each with a few of them only.
    hot = spark.range(400).select("id", F.lit(0).alias("commodity")).toDF("event", "commodity")
    assert bidding.similar_events(hot, hot).groupBy("similar").count().orderBy("similar").collect() == [(0, 399), (1, 399), (2, 399), (3, 3)]


def test_events_without_predictions_count_as_misses(spark):
    from tenderlake.operators.bidding import precision_at

    predicted = spark.createDataFrame([(1, 7, 1), (1, 8, 2)], "event long, vendor long, place long")
    bids = spark.createDataFrame([(1, 7), (1, 9), (2, 7), (2, 8)], "event long, vendor long")
    assert tuple(precision_at(predicted, bids, (1, 2), held=bids).first()) == (2, 0.5, 0.25, 0.25)
    assert tuple(precision_at(predicted, bids, (1, 2)).first()) == (1, 1.0, 0.5, 0.5)
    assert tuple(precision_at(predicted.limit(0), bids, (1, 2), held=bids).first()) == (2, 0.0, 0.0, 0.0)


def test_bids_are_dealt_by_event_in_parts_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(registry, "BIDS_PER_TASK", 5_000)
    met = registry.bids(spark, "/root/testdata/sf0.01").withColumn("part", F.spark_partition_id())
    sizes = met.groupBy("part").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n"), F.max("n")).first()
    assert sizes[0] == spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").count() and sizes[1] < 7_500
    assert met.select("event", "part").distinct().groupBy("event").count().where("count > 1").isEmpty()


def test_stream_and_batch_agree(spark, tmp_path):
    from tenderlake.session import table
    from tenderlake.streaming.observations import daily, latest_stream

    events = table(spark, SF, "events")
    events.unionByName(events).repartition(2).write.parquet(str(tmp_path / "in"))
    stream = daily(latest_stream(spark, str(tmp_path / "in"), events))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("daily_test").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert told(spark.table("daily_test").toPandas()) == told(daily(events).toPandas())


def test_analyze_writes_all_artifacts(spark, tmp_path):
    import json

    from tenderlake import cli

    order = QUERIES["s26_likely_bidders"](spark, SF).first()["event"]
    cli.main(["analyze", "--tables", SF, "--order", str(order), "--output", str(tmp_path / "out")])
    names = {p.name for p in (tmp_path / "out").iterdir()}
    assert names == {"opportunity_intelligence.json", "procurement_lineage.json", "documents_manifest.jsonl", "document_pages.jsonl", "vendor_profiles.json", "prime_candidates.json", "source_coverage.json", "review_queue.json", "report.md", "import"}
    assert {p.name for p in (tmp_path / "out" / "import").iterdir()} == {"validation_report.json", *(f"{x}.jsonl" for x in ("sources", "records", "participants", "documents", "document_content_handoff", "competitors", "partner_match_payloads"))}
    assert json.loads((tmp_path / "out" / "import" / "validation_report.json").read_text())["breaches"] == []


def test_analyze_writes_all_rows_or_says_so(spark, tmp_path, monkeypatch):
    import json

    from tenderlake.plans import analyze, registry

    order = QUERIES["s26_likely_bidders"](spark, SF).first()["event"]
    many = spark.range(10_050).select(F.col("id").alias("entity"), F.lit("review").alias("verdict"))
    monkeypatch.setitem(registry.QUERIES, "s23_vendor_resolution", lambda *_: many)
    monkeypatch.setitem(registry.QUERIES, "s33_source_coverage", lambda *_: many.withColumnRenamed("entity", "source"))
    monkeypatch.setitem(registry.QUERIES, "s16_lineage_score", lambda *_: many.select(F.lit(order).alias("record"), F.col("entity").alias("predecessor"), F.lit(3).alias("score")))
    counts = analyze.analyze_order(spark, SF, order, tmp_path / "out")
    read = lambda name: json.loads((tmp_path / "out" / name).read_text())
    assert counts["review_queue"] == counts["source_coverage"] == 10_050
    assert [r["entity"] for r in read("review_queue.json")] == [r["source"] for r in read("source_coverage.json")] == list(range(10_050))
    assert [r["predecessor"] for r in read("procurement_lineage.json")["predecessors"]] == list(range(10_050))
    with pytest.raises(ValueError, match="more than 10000 rows"):
        analyze._rows(many)
