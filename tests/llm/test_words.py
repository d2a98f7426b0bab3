"""Language-model scores, spelling variants and token alignment against brute force, and on odd documents."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tenderlake.llm import alignment, coded, neural, spelling

DOCS = "doc_id long, text string, words string, n long, pos long"


def frame(spark, rows):
    """With columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], DOCS)


# ---- chunks ----


@pytest.mark.parametrize("limit", [1, 50, 1 << 20])
def test_codes_give_the_words_back(spark, limit):
    rows = [(1, "Ab c\tAB  c\n"), (2, None), (3, ""), (4, "é É x"), (5, " x "), (None, "y" * 200)]
    got = coded.coded(frame(spark, rows).select("doc_id", "text"), "text", coded.split_words, limit).collect()
    told = sorted((str(d["doc_id"]), [r["words"][c] for c in d["codes"]]) for r in got for d in r["docs"])
    want = sorted((str(i), re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [""]) for i, t in rows)
    assert told == want and len({r["chunk"] for r in got}) == len(got)


def test_chunks_are_stored_in_row_groups_of_a_few(spark, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    from tenderlake.session import Scratch

    rows = [(i, " ".join(f"w{i}x{j}" for j in range(300))) for i in range(40)]
    chunks = coded.coded(frame(spark, rows).select("doc_id", "text").coalesce(1), "text", coded.split_words, 1 << 12)
    stored = coded.save(Scratch(spark, "t"), chunks, "chunks", coded.ROW_GROUPS | {"parquet.block.size": "20000"})
    (path,) = glob.glob(f"{stored._scratch_path.removeprefix('file:')}/*.parquet")
    found = pq.ParquetFile(path).metadata
    assert found.num_rows > 30 and max(found.row_group(i).num_rows for i in range(found.num_row_groups)) <= 10


# ---- language model ----


def sentences(spark, n=400):
    rng = random.Random(1)
    subject, verb, thing = "the cat|the dog|a bird|my friend".split("|"), "sees|eats|likes".split("|"), "fish.|bread.|the sun.|a stone.".split("|")
    rows = [(i, " ".join(f"{rng.choice(subject)} {rng.choice(verb)} {rng.choice(thing)}" for _ in range(8))) for i in range(n)]
    return rows + [(9001, None), (9002, ""), (9003, "Quite unseen words"), (9003, "Quite unseen words"), (None, "the cat"), (9004, "the cat\n" * 2000)]


def test_language_model_scores(spark):
    rows = sentences(spark)
    got = neural.score(frame(spark, rows), "doc_id", "text", neural.held_out("doc_id")).collect()
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [""] for i, t in rows}
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i in words}
    counts = collections.Counter(w for i, _ in rows for w in words[i] if not held[i])
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    for r in got:
        w = words[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(w), sum(x in counts for x in w), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w))
    apart = [r for r in got if r["held_out"] and (r["doc_id"] or 0) < 9000]
    assert len(apart) > 40 and sum(r["score"] for r in apart) > 0.7 * sum(r["base_score"] for r in apart)  # order is learned
    assert neural.score(frame(spark, rows).limit(0), "doc_id", "text", neural.held_out("doc_id")).count() == 0


def test_nothing_to_learn_from_and_few_classes(spark, monkeypatch):
    none = neural.score(frame(spark, [(1, "a b"), (2, None)]), "doc_id", "text", F.lit(True)).collect()
    assert [(r["n_known"], r["train_tokens"], r["base_score"]) for r in none] == [(0, 0, 0.0)] * 2 and all(abs(r["score"]) < 1e-6 for r in none)
    monkeypatch.setattr(neural, "CLASSES", 4)
    got = neural.score(frame(spark, sentences(spark, 60)), "doc_id", "text", neural.held_out("doc_id")).collect()
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_probabilities_sum_to_one_and_training_betters_them():
    rng = np.random.default_rng(0)
    top = [("", 40), ("a", 300), ("b", 200), ("c", 50)]
    model = neural.Model.fresh(top, 700, 60)
    classes = np.array([1, 2] * 400 + [3, 4] * 50, np.int32)
    own = neural.Learner(model, 0)
    for _ in range(5):
        own.learn(classes, np.array([0]))
    model.a, model.b, model.q = own.params
    first, second, norm = (x.astype(float) for x in model.tables())
    told = first[:, None, :] + second[None, :, :] - norm[:, :, None]
    assert np.allclose(np.exp(told).sum(2), 1, atol=1e-5)
    direct = np.einsum("ijk,vk->ijv", model.a[:, None, :-1] + model.b[None, :, :-1], model.q[:, :-1]) + model.q[:, -1]
    direct -= np.log(np.exp(direct).sum(2, keepdims=True))
    assert np.allclose(told, direct, atol=1e-4)
    assert np.exp(told[1, 2, 2]) > 0.6 and np.exp(told[2, 1, 1]) > 0.6  # b after a, a after b
    # Tokens of the last class: those seen, by their counts, and one that was not.
    rest = [c + 0.5 for c in [2] * 54 + [1, 1] + [0]]
    assert sum(rest) == pytest.approx(700 - 590 + 0.5 * 57) and model.rest == pytest.approx(700 - 590 + 0.5 * (60 - 4 + 1))
    assert model.start == 0


def test_contexts_begin_anew_with_each_text():
    one, two = neural.contexts(np.array([5, 6, 7, 8, 9, 9]), np.array([0, 3, 4]), 1)
    assert one.tolist() == [1, 5, 6, 1, 1, 9] and two.tolist() == [1, 1, 5, 1, 1, 1]


# ---- spelling ----


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_near_words_against_all_pairs(spark):
    rng = random.Random(2)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 8))) for _ in range(400)} | {"a" * 300, "a" * 301, "a" * 150 + "b" + "a" * 149}
    got = spelling.near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()
    want = {(a, b) for a, b in itertools.permutations(words, 2) if near(a, b)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_variants_against_brute_force(spark):
    rng = random.Random(3)
    base = ["Harbour", "harvour", "paving", "Pavingx", "tïmbers", "timbers", "granite", "granit", "gran"]
    rows = [(i, " ".join(rng.choices(base, weights=(60, 3, 40, 2, 2, 30, 50, 6, 5), k=20)) + ", x1harbour÷×-Paving") for i in range(60)] + [(7, None), (8, ""), (8, ""), (None, "Harbour " * 3), (9, "HARBOUR" * 2)]
    counts = spelling.word_counts(frame(spark, rows), "doc_id", "text", noise=spelling.NOISE)
    want = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            run = run[: h % len(run)] + run[h % len(run) + 1 :] if h % spelling.NOISE == 0 else run
            if len(run) >= spelling.LETTERS:
                want[run] += 1
    assert dict(counts.collect()) == dict(want)
    kept = {w: n for w, n in want.items() if n >= spelling.LEAST}
    form = {}
    for w, n in kept.items():
        others = sorted((-m, x) for x, m in kept.items() if near(w, x))
        form[w] = (others[0][1] if others and -others[0][0] >= spelling.FACTOR * n else None, len(others))
    got = {r["word"]: r for r in spelling.group_variants(counts.where(F.col("n") >= spelling.LEAST)).collect()}
    assert got.keys() == kept.keys() and len(kept) > 5 and any(f for f, _ in form.values())
    for w, r in got.items():
        root = w
        while form[root][0]:
            root = form[root][0]
        assert (r["form"], r["n_near"], r["root"], r["n"], r["form_n"]) == (*form[w], root, kept[w], kept.get(form[w][0]))
    assert spelling.group_variants(counts.limit(0)).count() == 0


def test_long_chains_of_forms_reach_their_roots_and_ties_go_to_the_smaller(spark):
    chain = [("a" * 6 + "bcdefgh"[:k], 5**k) for k in range(1, 8)]
    rows = [*chain, ("xyzxyz", 5), ("xyzxyx", 25), ("xyzxya", 25)]
    got = {r["word"]: r for r in spelling.group_variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert all(got[w]["root"] == chain[-1][0] for w, _ in chain)
    assert (got["xyzxyz"]["form"], got["xyzxyz"]["n_near"], got["xyzxyx"]["form"]) == ("xyzxya", 2, None)


def test_keys_of_words_are_not_broadcast(spark):
    from tenderlake.session import Scratch

    scratch = Scratch(spark, "words", sent=False)
    words = scratch.save(spark.createDataFrame([("letters", 9), ("lettersx", 5)], "word string, n long"), "words")
    near = spelling.near_words(words)
    assert sorted(map(tuple, near.collect())) == [("letters", "lettersx"), ("lettersx", "letters")]
    assert "Broadcast" not in near._jdf.queryExecution().executedPlan().toString()
    asked = words.join(F.broadcast(words.select("word", F.col("n").alias("m"))), "word")
    assert "BroadcastHashJoin" in asked._jdf.queryExecution().executedPlan().toString()


# ---- alignment ----

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, "a", " a", "a ", "  a  b  ", "a\n b\n\n  c \n", "\t x", "  y z", "▁", "x ▁y", "naïve café — “q”", "<|endoftext|> </s> <s>", "日本語のテキスト と 123", "😀😀 👩‍👩‍👧 x", "don't we'll I'D", "x" * 3000, "=" * 900 + " ok", "é \u0000 \x1f z", "1234567890 12 3", "a b c", "😀" * 400]


def brute_alignment(rows):
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
    found, counts = [], collections.Counter()
    for key, text in rows:
        true, links, groups, sides = f" {text or ''}".encode(), [], [], ([], [])
        if text:
            ids = a.encode(f" {text}", add_special_tokens=False).ids
            one = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in ids]
            two = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
            if b"".join(x for _, x in one) == true == b"".join(x for _, x in two):
                sides = tuple([(i, end) for (i, _), end in zip(s, itertools.accumulate(len(x) for _, x in s), strict=True)] for s in (one, two))
                start = 0
                for cut in sorted({e for _, e in sides[0]} & {e for _, e in sides[1]}):
                    groups.append([[i for i, e in s if start < e <= cut] for s in sides])
                    start = cut
                links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        counts.update(set(links))
        found.append((key, len(sides[0]), len(sides[1]), groups, links))
    best = collections.Counter()
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    told = lambda groups: ";".join("|".join(",".join(map(str, s)) for s in g) for g in groups)
    return [(k, n, m, len(g), len(ls), sum(counts[x] == best[x[0]] for x in ls), sum(counts[x] for x in ls), told(g)) for k, n, m, g, ls in found]


@pytest.mark.parametrize("large", [alignment.LARGE, 1])
def test_alignment_against_brute_force(spark, monkeypatch, large):
    monkeypatch.setattr(alignment, "LARGE", large)
    monkeypatch.setattr(alignment, "BLOCK", 50 * large)
    rng = random.Random(5)
    texts = [t for t in ODD if t]
    rows = list(enumerate(ODD)) + [(100 + i, " ".join(rng.choices(texts, k=3))) for i in range(20)] + [(7, "a b"), (7, "a b"), (None, "c d")]
    got = alignment.align(frame(spark, rows), "doc_id", "text", A, B).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, brute_alignment(rows)))
    assert sum(r["n_groups"] == 0 for r in got) >= 3  # null, empty, U+2581
    assert alignment.align(frame(spark, rows).limit(0), "doc_id", "text", A, B).count() == 0


def test_pairs_are_shuffled_where_they_are_many(spark, monkeypatch):
    rows = [(i, f"word{i % 7} and {i}") for i in range(40)]
    want = sorted(map(tuple, alignment.align(frame(spark, rows), "doc_id", "text", A, B).collect()))
    monkeypatch.setattr(alignment, "SENT", 0)
    assert sorted(map(tuple, alignment.align(frame(spark, rows), "doc_id", "text", A, B).collect())) == want == sorted(brute_alignment(rows))


def test_words_go_to_their_chunks_by_parts(spark, monkeypatch):
    save, written = alignment.Scratch.save, {}

    def counted(self, df, name="t", **options):
        out = save(self, df, name, **options)
        written.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(alignment.Scratch, "save", counted)
    rows = [(i, f"word{i % 7} and {i}") for i in range(40)] + [(40, None), (41, "")]
    want = sorted(brute_alignment(rows))
    for rounds in (1, 3, 50):
        monkeypatch.setattr(alignment, "ROUNDS", rounds)
        written.clear()
        assert sorted(map(tuple, alignment.align(frame(spark, rows).repartition(6), "doc_id", "text", A, B).collect())) == want
        assert len(written["documents"]) == len(written["held"]) == min(rounds, 6) and sum(written["documents"]) == len(rows)
        assert rounds == 1 or max(written["documents"]) < len(rows) / 2


def test_words_are_put_in_order_once(spark, monkeypatch):
    """No join finds the places of words, nor are their groups collected row by row; each round is sent its own words."""
    save, plans = alignment.Scratch.save, {}

    def told(self, df, name="t", **options):
        plans.setdefault(name, []).append(df._jdf.queryExecution().optimizedPlan().toString())
        return save(self, df, name, **options)

    monkeypatch.setattr(alignment.Scratch, "save", told)
    rows = [(i, f"word{i % 7} and {i}") for i in range(40)]
    assert sorted(map(tuple, alignment.align(frame(spark, rows).repartition(6), "doc_id", "text", A, B).collect())) == sorted(brute_alignment(rows))
    assert not any("Join" in p for p in plans["tokens"] + plans["held"] + plans["documents"]) and "collect_list" not in plans["words"][0]
    words = spark.createDataFrame([(0, [3], [7]), (1 << alignment.ROUND_BIT, [12], [8]), (2 << alignment.ROUND_BIT, [3, 12], [5, 6])], "wid long, chunks array<long>, at array<int>")
    assert [sorted(map(tuple, alignment.sent_in(words, k, [0, 10, 20]).collect())) for k in range(2)] == [[(3, 5), (3, 7)], [(12, 6), (12, 8)]]


def test_words_stay_whole_where_batches_part_them(spark, monkeypatch):
    rows = list(enumerate(ODD)) + [(100 + i, f"word{i % 3} {'=' * 40 * i} ok") for i in range(9)]
    want = sorted(map(str, brute_alignment(rows)))
    monkeypatch.setattr(alignment, "ROWS", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        assert sorted(str(tuple(r)) for r in alignment.align(frame(spark, rows).repartition(5), "doc_id", "text", A, B).collect()) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_borders_leave_tokens_alone():
    tokens = alignment.both_tokenizers(A, B)
    col = pa.array([t for t in ODD if t], pa.string())
    codes, offsets, words = alignment.split_at_borders(col)
    names = words.to_pylist()
    for row, text in enumerate(col.to_pylist()):
        parts = [names[c] for c in codes[offsets[row] : offsets[row + 1]]]
        assert " ".join(parts) == text
        for side in tokens:
            whole = side.encode([text])[0]
            assert list(whole) == [i for p in side.encode(parts) for i in p]


def test_query_digest_of_groups(spark):
    got = {r["doc_id"]: r for r in alignment.op13_token_alignment(spark, "/root/testdata/sf0.001").collect()}
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    for key, *numbers, groups in brute_alignment(rows):
        r = got[key]
        assert [r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] == numbers
        assert r["groups_sha256"] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
