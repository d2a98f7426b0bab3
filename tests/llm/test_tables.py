"""WARC, top-k, audio, near duplicates and the pipeline on small cases and against brute force."""

import collections
import hashlib
import random
import re
import struct
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tenderlake.llm import media, neardup, queries, topk, warc
from tenderlake.llm.common import Scratch

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    told = lambda df: sorted(map(tuple, df[sorted(df.columns)].convert_dtypes().astype(str).itertuples(index=False)))
    assert told(queries.QUERIES[name](spark, SF).toPandas()) == told(c.execute(queries.SQL[name]).df())


# ---- WARC ----


def test_revisits(spark):
    long, other = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 10, "b" * 150
    rows = [(5, "u5", long), (2, "u2\r\nX: y", long), (9, None, long), (3, "u", "short"), (4, "u", "short"), (6, "u", None), (7, "u", ""), (1, "u", other), (1, "u", other), (8, "u", other), (None, "u", other), (10, "u", "c" * 300_000)]
    rows += [(20 + i, "é", end + "x" * 120 * (i % 2) + end) for i, end in enumerate(["\r\n", "\r\n", "\r\n\r\n", "\r\n\r\n", "\r", "\n", "\r\n\r", "\0"])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    scratch = Scratch(spark, "t")
    for parts in (1, 5):
        path = scratch.path()
        warc.write_archives(df.repartition(parts), path, scratch, date="2024-05-06T07:08:09Z")
        got = warc.resolve(scratch.save(warc.read_archives(spark, path)), scratch).collect()
        assert len(got) == len(rows)
        kinds = collections.Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got if r["page_id"] is None or r["page_id"] < 20)
        assert kinds == collections.Counter({(2, "response", None): 1, (5, "revisit", 2): 1, (9, "revisit", 2): 1, (3, "response", None): 1, (4, "response", None): 1, (6, "response", None): 1, (7, "response", None): 1, (1, "response", None): 2, (8, "revisit", 1): 1, (None, "response", None): 1, (10, "response", None): 1})
        payload = {i: (h or "").encode() for i, _, h in rows}
        assert all((r["payload_bytes"], r["payload_digest"]) == (len(payload[r["page_id"]]), hashlib.sha256(payload[r["page_id"]]).hexdigest()) for r in got)
        heads = [r["value"] for r in spark.read.option("lineSep", warc.END).text(path).where("value LIKE '%WARC-Record-ID%'").collect()]
        assert len({re.search("WARC-Record-ID: (.*)", h)[1] for h in heads}) == len(heads) == len(rows)
        again = [h for h in heads if "WARC-Type: revisit" in h]
        assert len(again) == 3 and all("WARC-Refers-To-Date: 2024-05-06T07:08:09Z" in h and "WARC-Refers-To-Target-URI: u" in h for h in again)


def test_archives_without_records(spark):
    scratch = Scratch(spark, "t")
    path = scratch.path()
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path, scratch)
    assert warc.resolve(scratch.save(warc.read_archives(spark, path)), scratch).count() == 0


def test_a_record_of_another_length_is_an_error():
    good = [b"WARC/1.1\r\nContent-Length: 7", b"a\r\nb", b"c"]
    with pytest.raises(ValueError, match="another length"):
        list(warc.parse(good))
    with pytest.raises(ValueError, match="no record"):
        list(warc.parse([b"x", b"y"]))
    assert [b for _, b in warc.parse([b"WARC/1.1\r\nContent-Length: 9", b"a\r\nb", b"c", b"WARC/1.1\r\nContent-Length: 0", b"", b""])] == [b"a\r\nb\r\n\r\nc", b""]


# ---- top-k ----


def test_top_k_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6) * (100 if i % 17 == 0 else 1)]) for i in range(300)]
    rows += [(300, None), (301, [1.0, float("nan")]), (302, [1.0, None]), (303, []), (304, [float("inf")]), (305, [2.0]), (50, rows[50][1]), (100, rows[7][1]), (None, [1.0]), (306, rows[3][1]), (307, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"score": F.lit(1), "seq": F.lit("x"), "v": F.lit(2)})
    v = Scratch(spark, "t").save(topk.scaled(df, "vec_id", "embedding", 1024))
    queries_ = v.where("vec_id % 50 = 0")
    known = [(r["vec_id"], list(r["v"])) for r in v.collect()]
    assert len(known) == 305
    want = []
    for q, a in known:
        if q % 50 == 0:
            best = sorted(((i, sum(x * y for x, y in zip(a, b))) for i, b in known if i != q), key=lambda x: (-x[1], x[0]))[:10]
            want += [(q, rank + 1, i, s) for rank, (i, s) in enumerate(best)]
    for cells, rows_ in ((1 << 22, 4096), (1 << 22, 100), (60, 4096)):  # one shard, several, and several blocks of queries
        monkeypatch.setattr(topk, "GROUP_CELLS", cells)
        monkeypatch.setattr(topk, "SPLIT_ROWS", rows_)
        assert sorted(tuple(r) for r in topk.top_k(v, queries_, 10).collect()) == sorted(want)
    assert topk.top_k(v.limit(0), v.limit(0), 10).count() == 0 and topk.top_k(v, v.limit(0), 10).count() == 0
    few = [r for r in topk.top_k(v.where("vec_id < 4"), v.where("vec_id = 0"), 10).collect()]
    assert [r["rank"] for r in few] == [1, 2, 3]


@pytest.mark.parametrize("size", [1e6, 3e9, 3e15, 1e30])
def test_scores_beyond_64_bits(spark, size):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=3) * size]) for i in range(80)]
    v = Scratch(spark, "t").save(topk.scaled(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding", 1024))
    known = [(r["vec_id"], list(r["v"])) for r in v.collect()]
    held = lambda x: max(-(1 << 63), min((1 << 63) - 1, x))
    assert all(b == [held(int(np.floor(x * 1024))) for x in a[1]] for a, (_, b) in zip(rows, sorted(known)))
    want = sorted(((-held(sum(x * y for x, y in zip(known[0][1], b))), i) for i, b in known if i != known[0][0]))[:10]
    got = topk.top_k(v, v.where(F.col("vec_id") == known[0][0]), 10).orderBy("rank").collect()
    assert [(-r["score"], r["vec_id"]) for r in got] == want


def test_searches_look_at_a_part_of_the_components():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 32))
    rows = np.floor(1024 * (centres[rng.integers(0, 40, 4000)] + 0.1 * rng.normal(size=(4000, 32)))).astype(np.int64)
    shard = topk.Shard(np.arange(4000), rows, int(np.abs(rows).max()))
    for q in range(0, 4000, 100):
        scores, ids = shard.search(rows[q], q, 10)
        full = rows @ rows[q]
        full[q] = -(1 << 60)
        best = np.lexsort((np.arange(4000), -full))[:10]
        assert ids.tolist() == best.tolist() and scores.tolist() == full[best].tolist()
    assert shard.looked_at < 0.2 * 40 * rows.size
    text = np.floor(1024 * rng.normal(size=(500, 64))).astype(np.int64)  # nothing in common: still fewer than all
    shard = topk.Shard(np.arange(500), text, int(np.abs(text).max()))
    for q in range(5):
        shard.search(text[q], q, 10)
    assert shard.looked_at < 0.9 * 5 * text.size


# ---- audio ----


def test_tables_and_adpcm():
    assert media.MULAW_PCM[[0, 0x7F, 0x80, 0xFF]].tolist() == [-32124, 0, 32124, 0]
    assert media.ALAW_PCM[[0, 0x55, 0xD5, 0xFF]].tolist() == [-5504, -8, 8, 848]
    data = np.random.default_rng(1).integers(0, 256, 64 * 7, dtype=np.uint8)
    want = []
    for b in data.reshape(-1, 64).tolist():
        value, index = int.from_bytes(bytes(b[:2]), "little", signed=True), min(b[2], 88)
        want.append(value)
        for code in (c for x in b[4:] for c in (x & 15, x >> 4)):
            step = int(media.STEPS[index])
            diff = (step >> 3) + (step if code & 4 else 0) + (step >> 1 if code & 2 else 0) + (step >> 2 if code & 1 else 0)
            value = max(-32768, min(32767, value - diff if code & 8 else value + diff))
            index = max(0, min(88, index + (-1, -1, -1, -1, 2, 4, 6, 8)[code & 7]))
            want.append(value)
    assert media.decode_adpcm(data).ravel().tolist() == want


def brute_resample(x, up, down):
    """The filter as it is defined, sample by sample."""
    wide, out = max(up, down), []
    for n in range(-(-len(x) * up // down)):
        near = range((n * down - wide) // up, (n * down + wide) // up + 1)
        weights = [max(0, wide - abs(i * up - n * down)) for i in near]
        acc = sum(w * int(x[min(len(x) - 1, max(0, i))]) for i, w in zip(near, weights))
        out.append((2 * acc + sum(weights)) // (2 * sum(weights)))
    return out


@pytest.mark.parametrize(("up", "down"), [(1, 1), (2, 1), (1, 2), (1, 3), (3, 2), (2, 3), (441, 80), (80, 441)])
def test_resampling_against_its_definition(up, down):
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 64, 129):
        x = rng.integers(-32768, 32768, n).astype(np.int16)
        assert media.resample(x, up, down).tolist() == brute_resample(x, up, down)
    tone = (20000 * np.sin(np.pi * np.arange(400))).astype(np.int16) + np.int16(20000) * (-1) ** np.arange(400, dtype=np.int16)
    assert np.abs(media.resample(tone, 1, 2)[2:-2]).max() < 100  # what the lower rate can't hold is filtered out


def test_stored_audio_against_brute_force(spark):
    rows = [(1, "é" * 40), (2, None), (3, ""), (4, "é" * 40), (5, "x" * 64), (6, "long " * 60_000), (6, "again"), (6, "again"), (None, "id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"media": F.lit(0), "n_bytes": F.lit("x"), "pcm": F.lit(1)})
    stored = Scratch(spark, "t").save(media.resampled(media.store(df), media.PCM_RATE))
    got = sorted((tuple(r) for r in media.described(stored).collect()), key=str)
    want = []
    for i, text in rows:
        raw = (text or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        file = b"RIFF" + struct.pack("<I", 36 + len(payload)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 7, 1, 8000, 8000, 1, 8) + b"data" + struct.pack("<I", len(payload)) + payload
        mu, a = ([int(t[b]) for b in payload] for t in (media.MULAW_PCM, media.ALAW_PCM))
        adpcm = [int(x) for k in range(0, len(payload), 64) for x in media.decode_adpcm(np.frombuffer(payload[k : k + 64], np.uint8)).ravel()]
        pcm = np.array(brute_resample(mu, 1, 2), "<i2").tobytes()
        square = lambda xs: sum(x * x for x in xs)
        feature = f"mu={square(mu)};a={square(a)};adpcm={square(adpcm)};turns={sum((x < 0) != (y < 0) for x, y in zip(mu, mu[1:]))};pcm={zlib.crc32(pcm):08x}"
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want.append((i, len(raw), len(payload), sha(payload), zlib.crc32(payload[-64:]), len(file), sha(file), feature, 4000, len(pcm), sha(pcm)))
    assert got == sorted(want, key=str)
    for k in (media.PCM, media.ALAW, media.MULAW, media.ADPCM):
        assert bytes(media.samples(media.wave(b"\1" * 128, k))[2]) == b"\1" * 128
    assert media.described(media.resampled(media.store(df.limit(0)))).count() == 0


# ---- near duplicates ----


def shingled(text, width):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(w)} if 0 < len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if w else set()


def brute_components(rows, width, num, den):
    sets = [(i, shingled(t, width)) for i, t in rows]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for i, _ in rows:
        root(i)
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets)


@pytest.mark.parametrize(("width", "num"), [(3, 85), (5, 80)])
def test_components_against_brute_force(spark, width, num):
    rng = random.Random(8)
    rows, base = [], [[f"w{rng.randrange(400)}" for _ in range(rng.choice([12, 60, 200]))] for _ in range(12)]
    for i in range(220):
        w = list(base[i % 12])
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            w[rng.randrange(len(w))] = f"n{rng.randrange(400)}"
        rows.append((i, " ".join(w).upper() if rng.random() < 0.1 else "\t".join(w)))
    rows += [(300, None), (301, ""), (302, " \n"), (303, "one two"), (304, "ONE  two"), (305, "one"), (306, "é à\xa0b c"), (307, "word " * 40_000), rows[5], rows[5]]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit(1), "n": F.lit("x")})
    got = sorted(tuple(r) for r in neardup.near_duplicates(df, width=width, num=num).collect())
    assert got == brute_components(rows, width, num, 100)


def near_copies(rng, base, least, most, words=10**6):
    """base with some of its words changed, each to a new one."""
    w = list(base)
    for at in rng.sample(range(len(w)), rng.randint(least, most)):
        w[at] = f"n{rng.randrange(words)}"
    return " ".join(w)


def test_pairs_formed_grow_with_the_group_and_not_with_its_square(spark, monkeypatch):
    save, formed = Scratch.save, {}

    def counted(self, df, name="t"):
        out = save(self, df, name)
        formed[name] = out.count() if name in ("pairs", "diffs", "best") else 0
        return out

    monkeypatch.setattr(neardup.Scratch, "save", counted)
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    for size in (200, 800):
        rows = [(0, " ".join(base))] + [(i, near_copies(rng, base, 2, 9)) for i in range(1, size)]
        got = sorted(tuple(r) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=3, num=85).collect())
        assert got == brute_components(rows, 3, 85, 100)
        assert 1 < sum(r[3] for r in got) < size  # some are apart from all others
        assert formed["pairs"] <= size and formed["diffs"] <= 20 * size and formed["best"] < size


def test_links_between_sets_apart_from_their_hub(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = [(i, near_copies(rng, base, 0, 3)) for i in range(40)]
    for family in range(12):  # families far from the base, near to one another, some by a chain only
        w = near_copies(rng, base, 5, 12).split()
        for i in range(6):
            rows.append((100 + 10 * family + i, near_copies(rng, w, 0, 4, 300)))
            if i % 2:
                w = rows[-1][1].split()[rng.randrange(4) :]
    got = sorted(tuple(r) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=3, num=85).collect())
    assert got == brute_components(rows, 3, 85, 100)


def test_documents_with_several_texts(spark):
    rng = random.Random(11)
    base = [[f"w{rng.randrange(5000)}" for _ in range(100)] for _ in range(6)]
    rows = [(i, near_copies(rng, base[i % 6], 0, 6)) for i in range(60)]
    rows += [(i, near_copies(rng, base[(i + 1) % 6], 0, 6)) for i in (0, 7, 20)]  # these join two groups
    rows += [(i, " ".join(base[0])) for i in (70, 70, 71)] + [(72, t) for t in ("a b c d", "e f g h", "", None)] + [(73, "e f g h")]
    rows += [(74, " ".join(base[2]))] * 30
    got = sorted(tuple(r) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=3, num=85).collect())
    assert got == brute_components(rows, 3, 85, 100)


def test_recall_of_pairs_near_the_threshold(spark):
    rng, rows, links = random.Random(10), [], 0
    while links < 300:
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([60, 150, 400]))]
        other = near_copies(rng, base, 1, max(2, len(base) // 30))
        a, b = shingled(" ".join(base), 3), shingled(other, 3)
        if 0.85 <= len(a & b) / len(a | b) < 0.9:
            rows += [(2 * links, " ".join(base)), (2 * links + 1, other)]
            links += 1
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=3, num=85)
    assert got.where("component_id = doc_id - doc_id % 2").count() == 600


def test_no_documents_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c d e f g h i"), (1, "a b c d e f g h i")], "doc_id long, text string")
    assert sorted(map(str, neardup.near_duplicates(df).select("component_id", "kept").collect())) == ["Row(component_id=1, kept=True)", "Row(component_id=None, kept=True)"]
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_index_finds_all_pairs_within_the_distance():
    rng = np.random.default_rng(3)
    for most in (12, 29, 40):
        masks = neardup.index_masks(most)
        for _ in range(200):
            a = np.zeros(8 * neardup.LONGS, np.uint8)
            a[: neardup.SYMBOLS] = rng.integers(0, 256, neardup.SYMBOLS)
            b = a.copy()
            at = rng.choice(neardup.SYMBOLS, most, replace=False)
            b[at] = b[at] + rng.integers(1, 256, most, dtype=np.uint8)
            x, y = a.view(np.int64), b.view(np.int64)
            assert any(all(int(x[i]) & m == int(y[i]) & m for i, m in key.items()) for key in masks)
            assert most > 39 or all(sum((m % (1 << 64)).bit_count() for m in key.values()) >= 32 for key in masks)


def test_components_of_links_in_one_task_and_in_several(spark):
    rng = random.Random(3)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    links = [(a, b) for a, b in links if a != b]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    scratch = Scratch(spark, "t")
    stored = scratch.save(spark.createDataFrame(links, "a long, b long").repartition(6))
    for per_task in (10**6, 30):
        assert dict(neardup.components(stored, scratch, per_task).collect()) == {x: root(x) for x in up}


def test_near_duplicates_broadcast_nothing_by_its_compressed_size(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(6)] + [(7, " ".join(f"w0x{j}" for j in range(40)) + " end")]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=3, num=85)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {**{i: i for i in range(6)}, 7: 0}
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_near_duplicates_send_nothing_through_the_driver(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = [(i, near_copies(rng, base, 0, 3)) for i in range(20)]
    for family in range(4):
        w = near_copies(rng, base, 5, 12).split()
        rows += [(100 + 10 * family + i, near_copies(rng, w, 0, 4, 300)) for i in range(6)]
    rows += [(101, rows[0][1])]  # a document with two texts
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, width=3, num=85).collect()}
    assert got == {r[0]: r[2] for r in brute_components(rows, 3, 85, 100)}
    assert corpus_pipeline.near_dedup(spark, docs, SF).count() > 0
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    ran = store.executionsList()
    plans = [ran.apply(i).physicalPlanDescription() for i in range(before, ran.size())]
    assert len(plans) > 40 and not any("BroadcastExchange" in p for p in plans)  # as they were carried out


# ---- pipeline ----


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scratch, seen = Scratch(spark, "t"), [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = scratch.save(stage(spark, seen[-1], SF), name)
        assert name == "packing" or out.columns == docs.columns
        seen.append(out)
    ids = [{r[0] for r in d.select("doc_id").distinct().collect()} for d in seen]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and ids[-1] == ids[-2] == ids[3]
    text = {r[0]: r[1] for r in seen[2].select("doc_id", "text").collect()}
    left = [(i, text[i]) for i in sorted(text)]
    assert ids[3] == {i for i, _, _, kept in brute_components(left, 5, 80, 100) if kept}
    assert not any('token = "0' in (r[0] or "") for r in seen[4].select("text").collect())


@pytest.fixture
def odd_documents(spark):
    rng = random.Random(5)
    words = {"en": "the of and water house tree with from under river".split(), "fr": "les des une avec pour dans sur maison eau arbre".split()}
    rows = []
    for i in range(80):
        lang = ("en", "fr")[i % 2]
        rows.append((i, " ".join(rng.choices(words[lang], k=40)) + ".", lang, "s"))
    rows += [(100, None, "en", "s"), (101, "", None, None), (102, "12 !?", "en", "s"), (103, rows[3][1], None, None), (104, rows[3][1] + " x", "fr", "s"), (None, rows[3][1], "fr", "s"), rows[5], rows[5]]
    rows += [(105, rows[7][1] + ' token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" ' + rows[9][1], "fr", "s"), (106, "the water of the river " * 20_000, "en", "s")]
    rows += [(110 + i, "the same line of some length\n" + " ".join(rng.choices(words["en"], k=30)), "en", "s") for i in range(4)] + [(114, "the same line of some length", "en", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.char_length("text").cast("long"))
    return df.withColumns({c: F.concat(F.lit(f"own {c} "), F.coalesce("doc_id", F.lit(-1))) for c in CLASHING})


CLASHING = ["_score", "_lang_pred", "_clean_text", "_findings", "_kept_text", "_lines", "id", "n", "kept", "component_id", "__score"]


def test_pipeline_on_odd_documents(spark, odd_documents):
    scratch, docs = Scratch(spark, "t"), odd_documents
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = scratch.save(stage(spark, docs, SF), name)
        seen[name] = docs
        if name != "packing":
            assert docs.columns == columns
            assert all(r[c] == f"own {c} {-1 if r['doc_id'] is None else r['doc_id']}" for r in docs.collect() for c in CLASHING)
    ids = {name: collections.Counter(r["doc_id"] for r in df.select("doc_id").collect()) for name, df in seen.items()}
    assert not {100, 101, 102} & set(ids["language_id"]) and ids["language_id"][5] == 3 and ids["language_id"][None] == 1
    text = {r["doc_id"]: r["text"] for r in seen["line_dedup"].collect()}
    assert not any("same line" in text[110 + i] for i in range(4)) and text[114] == "the same line of some length"
    assert ids["near_dedup"][3] == 1 and not {103, 104} & set(ids["near_dedup"]) and ids["near_dedup"][5] == 3 and ids["near_dedup"][None] == 1
    assert "04dbebab" not in "".join(r["text"] for r in seen["secret_scan"].collect()) and ids["secret_scan"] == ids["near_dedup"]
    assert set(ids["packing"]) == set(ids["secret_scan"])


def test_pipeline_of_no_documents(spark, odd_documents, tmp_path):
    odd_documents.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
