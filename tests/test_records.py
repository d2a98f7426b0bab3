"""Record ingestion: the required fields, keys, trimming, defaults, malformed files, sinks and the command line."""

import json

import pytest
from pyspark.sql import functions as F

from tenderlake import cli
from tenderlake.functions.expr import WHITESPACE, canonical_id, strip
from tenderlake.operators.normalize import judged, opportunities, review_queue, split_counts, with_instants
from tenderlake.sources.records import ADAPTERS, parse_records, read_records, renamed_fields
from tenderlake.sources.sinks import write_jsonl, write_tables

BASE = {"source_id": "notice 7", "source_url": "https://portal.invalid/notices/7", "solicitation": "ITT 2031/07", "title": "Bridge repair", "agency": "Harbour Board", "jurisdiction": "Westland", "observed_at": "2031-03-04T05:06:07Z"}


def rows_of(spark, values):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    text = [(f"f{i}", v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return {int(r["file"][1:]): r for r in judged(parse_records(spark.createDataFrame(text, "file string, text string"))).collect()}


def test_key_ignores_case_and_edges(spark):
    df = spark.createDataFrame([("Harbour Board", "ITT 7"), ("\tharbour BOARD ", "itt 7 "), ("　HARBOUR board\x1c", "\nItt 7\xa0")], "a string, s string")
    assert len({r[0] for r in df.select(canonical_id(F.col("a"), F.col("s"))).collect()}) == 1


def test_known_keys(spark):
    # Keys that records of this kind are known by elsewhere.
    df = spark.createDataFrame([("Example City", "RFP-26-101"), ("Example County", "IFB-44")], "a string, s string")
    assert [r[0] for r in df.select(canonical_id(F.col("a"), F.col("s"))).collect()] == ["dcd5549162a0e2c6", "98e3a7a74b8fbe3e"]


def test_provenance_and_default_status(spark):
    r = rows_of(spark, [BASE])[0]
    assert (r["source_ids"], r["source_urls"], r["status"], r["confidence"], r["error"]) == ([BASE["source_id"]], [BASE["source_url"]], "unknown", 1.0, None)


def test_missing_fields_are_named_in_order(spark):
    assert rows_of(spark, [{"title": "Only a name"}])[0]["error"] == "missing required fields: source_id, source_url, solicitation, agency, jurisdiction, observed_at"


@pytest.mark.parametrize("value", ["", 0, 0.0, False, None, [], {}])
def test_falsy_is_missing(spark, value):
    assert rows_of(spark, [BASE | {"title": value}])[0]["error"] == "missing required fields: title"


def test_fields(spark):
    cases = [BASE | {"title": " "}, BASE | {"status": None}, BASE | {"status": ""}, BASE | {"confidence": 0.5}, BASE | {"confidence": "0.5"}, BASE | {"confidence": "abc"}, BASE | {"confidence": None}, BASE | {"title": 5}, 7, '{"a":', "[]", json.dumps(BASE)[:-1] + ', "title": "last"}', {**{k: v for k, v in BASE.items() if k != "title"}, "Title": "t"}]
    r = rows_of(spark, cases)
    assert r[0]["error"] is None and r[0]["title"] == ""
    assert (r[1]["status"], r[2]["status"]) == (None, "")
    assert (r[3]["confidence"], r[4]["confidence"]) == (0.5, 0.5)
    assert r[5]["error"] == r[6]["error"] == "invalid confidence"
    assert r[7]["error"] == "wrong_type: title" and r[8]["error"] == "wrong_type: record" and r[9]["error"] == "malformed_json"
    assert 10 not in r and r[11]["title"] == "last" and r[12]["error"] == "missing required fields: title"


def test_strip_agrees_with_python(spark):
    text = [chr(c) + "a" + chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    got = spark.createDataFrame([(t,) for t in text], "t string").select("t", strip(F.col("t")).alias("s")).collect()
    assert all(r["s"] == r["t"].strip() for r in got) and len(WHITESPACE) == 29


def test_directory_and_sinks(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "b.json").write_text(json.dumps(BASE | {"source_id": "b"}))
    (source / "a.json").write_text(json.dumps([BASE, BASE | {"source_id": "a2", "agency": "École"}, {"title": "x"}]))
    (source / "c.json").write_text("[{")
    (source / "note.txt").write_text("no record")
    rows = judged(read_records(spark, str(source)))
    assert [r["source_ids"][0] for r in opportunities(rows).orderBy("file", "pos").collect()] == ["notice 7", "a2", "b"]
    assert review_queue(rows).count() == 2 and tuple(split_counts(rows).first()) == (3, 2)
    assert with_instants(rows).where("observed_ts IS NOT NULL").count() == 3
    cli.main(["normalize", "--input", str(source), "--output", str(tmp_path / "out")])
    text = (tmp_path / "out" / "opportunities.json").read_text()
    assert text.endswith("]\n") and "\\u00c9cole" in text
    assert list(json.loads(text)[0]) == ["canonical_id", "title", "agency", "jurisdiction", "status", "due_date", "source_ids", "source_urls", "observed_at", "confidence"]
    assert json.loads((tmp_path / "out" / "review_queue.json").read_text())[0]["record"] == {"title": "x"}
    with pytest.raises(SystemExit):
        cli.main(["normalize", "--input", str(source), "--output", str(source)])
    write_tables(rows, str(tmp_path / "tables"))
    assert spark.read.parquet(str(tmp_path / "tables/opportunities")).count() == 3
    write_jsonl(rows.select("canonical_id", "due_date"), str(tmp_path / "lines"))
    assert "due_date" in spark.read.json(str(tmp_path / "lines")).columns


def test_tables_from_the_command_line(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps([BASE, {"title": ""}, BASE]))
    cli.main(["normalize", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--format", "tables"])
    assert "normalized=2 review=1" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "out" / "opportunities")).count() == 2
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "e.json").write_text("[]")
    cli.main(["normalize", "--input", str(tmp_path / "none"), "--output", str(tmp_path / "out2")])
    assert json.loads((tmp_path / "out2" / "opportunities.json").read_text()) == []


def test_adapters(spark):
    assert {"canonical", "flat_portal", "nested_portal"} <= set(ADAPTERS)
    adapt = renamed_fields({"title": "name", "agency": "buyer.name"})
    theirs = {k: v for k, v in BASE.items() if k not in ("title", "agency")} | {"name": "Their title", "buyer": {"name": "Their agency"}}
    cases = [theirs, theirs | {"title": "Own title"}, theirs | {"name": False}, theirs | {"name": 0}, theirs | {"name": 5}, theirs | {"title": "", "name": "x"}, theirs | {"status": None}, 7, '{"a":', json.dumps(theirs)[:-1] + ', "name": "last"}']
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    text = [(f"f{i}", c if isinstance(c, str) else json.dumps(c)) for i, c in enumerate(cases)]
    rows = judged(adapt(parse_records(spark.createDataFrame(text, "file string, text string")))).collect()
    r = {int(x["file"][1:]): x for x in rows}
    assert [(r[i]["title"], r[i]["agency"], r[i]["error"]) for i in (0, 1)] == [("Their title", "Their agency", None), ("Own title", "Their agency", None)]
    assert [r[i]["error"] for i in (2, 3, 5)] == ["missing required fields: title"] * 3 and r[4]["error"] == "wrong_type: title"
    assert r[6]["status"] is None and r[0]["status"] == "unknown" and r[9]["title"] == "last"
    assert r[7]["error"] == "wrong_type: record" and r[8]["error"] == "malformed_json" and json.loads(r[0]["record"]) == theirs
