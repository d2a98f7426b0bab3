"""The registered queries and their SQL.

The driver's tables hold no procurement data and stand in for it: nation = jurisdiction, customer = buyer,
order = procurement event or record, lineitem = bid, supplier = vendor, part = commodity, pages = portal
pages, documents = attachments, events = observations.  Awards are synthetic (see operators/bidding.py).
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenderlake.functions import expr
from tenderlake.operators import assemble, bidding, contracts, dedupe, differences, documents, lineage, linkage, merge, metrics, normalize, prediction, spend
from tenderlake.plans import exports
from tenderlake.session import Scratch, table
from tenderlake.sources.records import ADAPTERS, REGISTRY, parse_records, read_registry
from tenderlake.sources.sinks import write_jsonl

QUERIES: dict = {}
SQL: dict[str, str] = {}
CUTOFF = "1997-01-01"


def query(sql: str):
    """Registers a function under its name, with the SQL that gives the same rows."""

    def put(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return put


#: Bids that one task orders or counts by event; Spark would join tasks until their files are of its advisory size, of some millions of bids.
BIDS_PER_TASK = 500_000


def bids(spark, sf_dir):
    """The bids, dealt by event, so that what is told of events needs no further shuffle; the number of parts grows with the bids."""
    item, order, part = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    n = -(-item.count() // BIDS_PER_TASK) or 1
    typed = item.join(part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"), "left")
    met = typed.repartition(n, "l_orderkey").join(order.repartition(n, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return met.select(F.col("l_orderkey").alias("event"), F.col("l_suppkey").alias("vendor"), F.col("o_custkey").alias("buyer"), F.col("l_partkey").alias("commodity"), F.col("p_type").alias("category"), F.col("l_extendedprice").alias("amount"), F.col("o_orderdate").alias("date"), F.col("l_linenumber").alias("line"))


def awarded(spark, sf_dir):
    return bidding.with_awards(bids(spark, sf_dir))


def stored(df, name):
    """What several parts of a query read, computed once."""
    return Scratch(df.sparkSession, name).save(df, name)


BIDS = """b0 AS (
  SELECT l_orderkey AS event, l_suppkey AS vendor, o_custkey AS buyer, l_partkey AS commodity, p_type AS category, l_extendedprice AS amount, o_orderdate AS date, l_linenumber AS line
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey),
bids AS (SELECT *, row_number() OVER (PARTITION BY event ORDER BY amount, line, vendor, commodity) = 1 AS won FROM b0)"""

# ---- records ----


@query("SELECT c_custkey, substr(sha256(lower(trim(c_name)) || '::' || lower('RFP-' || c_custkey || '-' || trim(n_name))), 1, 16) AS canonical_id FROM customer JOIN nation ON n_nationkey = c_nationkey")
def i10_canonical_id(spark, sf_dir):
    met = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return met.select("c_custkey", expr.canonical_id(F.concat(F.lit(" "), "c_name", F.lit("\t")), F.concat(F.lit("rfp-"), F.col("c_custkey").cast("string"), F.lit("-"), "n_name")).alias("canonical_id"))


def _raw(spark, sf_dir):
    """Raw JSON records from buyers: some fields blank, absent, null or wrong by fixed rules."""
    met = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    put = lambda name, value: F.concat(F.lit(f', "{name}": '), value)
    text = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    raw = F.concat(
        F.lit('{"source_id": "C-'), k.cast("string"), F.lit('", "source_url": "https://example.invalid/'), k.cast("string"), F.lit('"'),
        put("solicitation", text(F.concat(F.lit("RFP-"), k.cast("string")))),
        put("title", F.when(k % 7 == 0, F.lit('""')).when(k % 17 == 0, F.lit("5")).otherwise(text(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))))),
        F.when(k % 11 == 0, "").otherwise(put("agency", text(F.col("c_name")))),
        put("jurisdiction", text(F.col("n_name"))), put("observed_at", F.lit('"2026-09-05T18:00:00Z"')),
        F.when(k % 3 == 0, "").otherwise(put("status", F.when(k % 5 == 0, F.lit("null")).otherwise(F.lit('"open"')))),
        F.when(k % 2 == 0, "").otherwise(put("confidence", F.when(k % 13 == 0, F.lit('"abc"')).otherwise(F.lit('"0.5"')))),
        F.when(k % 4 == 0, "").otherwise(put("due_date", F.when(k % 4 == 1, F.lit("null")).when(k % 4 == 2, F.lit('""')).otherwise(F.lit('"2026-10-01T21:00:00Z"')))), F.lit("}"),
    )
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return normalize.judged(parse_records(met.select(k.cast("string").alias("file"), raw.alias("text"))))


RAW = """raw AS (
  SELECT c_custkey AS k, c_name, c_mktsegment, n_name, CASE WHEN c_custkey % 4 = 2 THEN '' WHEN c_custkey % 4 = 3 THEN '2026-10-01T21:00:00Z' END AS due, CASE
    WHEN c_custkey % 7 = 0 AND c_custkey % 11 = 0 THEN 'missing required fields: title, agency'
    WHEN c_custkey % 7 = 0 THEN 'missing required fields: title'
    WHEN c_custkey % 11 = 0 THEN 'missing required fields: agency'
    WHEN c_custkey % 17 = 0 THEN 'wrong_type: title'
    WHEN c_custkey % 2 = 1 AND c_custkey % 13 = 0 THEN 'invalid confidence' END AS error
  FROM customer JOIN nation ON n_nationkey = c_nationkey)"""


@query(f"""WITH {RAW} SELECT CAST(k AS VARCHAR) AS file, error,
  CASE WHEN error IS NULL THEN substr(sha256(lower(c_name) || '::' || lower('RFP-' || k)), 1, 16) END AS canonical_id,
  CASE WHEN error IS NULL THEN c_mktsegment END AS title,
  CASE WHEN error IS NULL THEN CASE WHEN k % 3 = 0 THEN 'unknown' WHEN k % 5 = 0 THEN NULL ELSE 'open' END END AS status,
  CASE WHEN error IS NULL THEN CASE WHEN k % 2 = 0 THEN 1.0 ELSE 0.5 END END::DOUBLE AS confidence FROM raw""")
def i07_normalize_split(spark, sf_dir):
    good = F.col("error").isNull()
    return _raw(spark, sf_dir).select("file", "error", *[F.when(good, F.col(c)).alias(c) for c in ("canonical_id", "title", "status", "confidence")])


@query(f"WITH {RAW} SELECT count(*) FILTER (WHERE error IS NULL) AS normalized, count(*) FILTER (WHERE error IS NOT NULL) AS review FROM raw")
def i23_split_counts(spark, sf_dir):
    return normalize.split_counts(_raw(spark, sf_dir))


@query(f"WITH {RAW} SELECT CAST(k AS VARCHAR) AS file, due AS due_date, '2026-09-05T18:00:00Z' AS observed_at FROM raw WHERE error IS NULL")
def i17_nullable_pass_through(spark, sf_dir):
    return normalize.opportunities(_raw(spark, sf_dir)).select("file", "due_date", "observed_at")


@query(f"WITH {RAW} SELECT CAST(k AS VARCHAR) AS file, 1 AS n_ids, 'C-' || k AS source_id, 1 AS n_urls, 'https://example.invalid/' || k AS source_url FROM raw WHERE error IS NULL")
def i18_singleton_arrays(spark, sf_dir):
    good = normalize.opportunities(_raw(spark, sf_dir))
    return good.select("file", F.size("source_ids").alias("n_ids"), F.array_join("source_ids", "|").alias("source_id"), F.size("source_urls").alias("n_urls"), F.array_join("source_urls", "|").alias("source_url"))


@query(f"""WITH {RAW} SELECT CAST(k AS VARCHAR) AS file, '{{"canonical_id":"' || substr(sha256(lower(c_name) || '::' || lower('RFP-' || k)), 1, 16) || '","title":"' || c_mktsegment || '","agency":"' || c_name || '","jurisdiction":"' || n_name
  || '","status":' || CASE WHEN k % 3 = 0 THEN '"unknown"' WHEN k % 5 = 0 THEN 'null' ELSE '"open"' END || ',"due_date":' || coalesce('"' || due || '"', 'null') || ',"source_ids":["C-' || k || '"],"source_urls":["https://example.invalid/' || k
  || '"],"observed_at":"2026-09-05T18:00:00Z","confidence":' || CASE WHEN k % 2 = 0 THEN '1.0' ELSE '0.5' END || '}}' AS line FROM raw WHERE error IS NULL""")
def i20_plain_records(spark, sf_dir):
    return normalize.plain_records(_raw(spark, sf_dir)).select("file", "line")


def _portal(spark, sf_dir):
    """Raw records of two portals, of suppliers: even ones flat, odd ones nested; some titles falsy, some fields under both names."""
    sup = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    k, key = F.col("s_suppkey"), F.col("s_suppkey").cast("string")
    title = F.when(k % 5 == 0, F.lit("0")).when(k % 7 == 0, F.lit("false")).when(k % 11 == 0, F.lit("5")).otherwise(F.concat(F.lit('"'), "s_name", F.lit('"')))
    own = F.when(k % 3 == 0, F.concat(F.lit(',"title":"own '), key, F.lit('"'))).otherwise("")
    flat = F.concat(F.lit('{"id":"'), key, F.lit('","link":"u","bid_number":"B-'), key, F.lit('","name":'), title, F.lit(',"department":"Roads","state":"'), "n_name", F.lit('","fetched":"t","phase":null'), own, F.lit("}"))
    nested = F.concat(F.lit('{"meta":{"id":"'), key, F.lit('","url":"u","seen":"t"},"notice":{"number":"B-'), key, F.lit('","title":'), title, F.lit('},"buyer":{"name":"Roads","region":"'), "n_name", F.lit('"}'), own, F.lit("}"))
    return sup.select(key.alias("file"), F.when(k % 2 == 0, flat).otherwise(nested).alias("text"), k)


@query("""WITH p AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 = 0 THEN 'own ' || s_suppkey WHEN s_suppkey % 5 = 0 OR s_suppkey % 7 = 0 OR s_suppkey % 11 = 0 THEN NULL ELSE s_name END AS title,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL WHEN s_suppkey % 5 = 0 OR s_suppkey % 7 = 0 THEN 'missing required fields: title' WHEN s_suppkey % 11 = 0 THEN 'wrong_type: title' END AS error FROM supplier JOIN nation ON n_nationkey = s_nationkey)
SELECT CASE WHEN k % 2 = 0 THEN 'flat_portal' ELSE 'nested_portal' END AS adapter, CAST(k AS VARCHAR) AS file, error, title, CASE WHEN error IS NULL THEN substr(sha256('roads::b-' || k), 1, 16) END AS canonical_id, CASE WHEN k % 2 = 1 THEN 'unknown' END AS status FROM p""")
def s07_portal_adapters(spark, sf_dir):
    raw, found = _portal(spark, sf_dir), []
    for name, odd in (("flat_portal", 0), ("nested_portal", 1)):
        rows = normalize.judged(ADAPTERS[name](parse_records(raw.where(F.col("s_suppkey") % 2 == odd).drop("s_suppkey"))))
        good = F.col("error").isNull()
        found.append(rows.select(F.lit(name).alias("adapter"), "file", "error", F.when(good, F.col("title")).alias("title"), F.when(good, F.col("canonical_id")).alias("canonical_id"), F.col("status")))
    return found[0].unionByName(found[1])


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, coalesce(json_extract_string(props, '$.status'), 'unknown') AS status FROM events")
def i04_json_props(spark, sf_dir):
    v = F.try_parse_json("props")
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(v, "$.k", "long").alias("k"), F.coalesce(F.try_variant_get(v, "$.status", "string"), F.lit("unknown")).alias("status"))


@query("SELECT vec_id, CAST(unnest(range(len(embedding))) AS BIGINT) AS pos, CAST(floor(1000 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS milli FROM embeddings")
def i05_explode_records(spark, sf_dir):
    one = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("p", "x"))
    return one.select("vec_id", F.col("p").cast("long").alias("pos"), F.floor(F.col("x").cast("double") * 1000).alias("milli"))


@query("SELECT c_name AS name, c_nationkey AS place FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier UNION ALL SELECT s_name, s_nationkey FROM supplier")
def i06_bag_union(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("place"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("place"))
    return c.unionByName(s).unionByName(s)


@query("""SELECT n_name AS coverage, 'portal, "' || r_name || '"' AS portal, 'https://example.invalid/' || n_nationkey AS official_url, CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE 'bids' END AS data_type, CAST(n_nationkey AS VARCHAR) AS identifiers, 'line one' || chr(10) || 'line two' AS gaps
FROM nation JOIN region ON r_regionkey = n_regionkey""")
def s43_source_registry(spark, sf_dir):
    """A registry of portals by nation, written as CSV with quotes and line feeds in fields and read back."""
    met = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    said = {"coverage": F.col("n_name"), "portal": F.concat(F.lit('portal, "'), "r_name", F.lit('"')), "official_url": F.concat(F.lit("https://example.invalid/"), F.col("n_nationkey").cast("string")), "data_type": F.when(F.col("n_nationkey") % 3 != 0, "bids"), "identifiers": F.col("n_nationkey").cast("string"), "gaps": F.lit("line one\nline two")}
    path = Scratch(spark, "registry").path("csv")
    met.select(*[said.get(c, F.lit(None).cast("string")).alias(c) for c in REGISTRY]).write.csv(path, header=True, escape='"')
    return read_registry(spark, path).select(*said)


# ---- duplicates and identities ----


@query("SELECT sha256(text) AS content_hash, count(*) AS n_rows, min(doc_id) AS first_id, count(DISTINCT source) AS n_origins FROM documents GROUP BY 1 HAVING count(*) > 1")
def s01_exact_duplicates(spark, sf_dir):
    return dedupe.exact_duplicates(table(spark, sf_dir, "documents"), F.sha2("text", 256), "doc_id", "source")


@query(r"""WITH c AS (SELECT min(doc_id) AS id, any_value(text) AS text FROM documents GROUP BY sha256(text)),
w AS (SELECT id, string_split(trim(regexp_replace(lower(text), '\s+', ' ', 'g')), ' ') AS w FROM c),
s AS (SELECT id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4])) ELSE [] END AS s FROM w),
n AS (SELECT id, len(s) AS n FROM s), x AS (SELECT id, unnest(s) AS sh FROM s),
y AS (SELECT * FROM x WHERE sh IN (SELECT sh FROM x GROUP BY sh HAVING count(*) > 1)),
p AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS common FROM y a JOIN y b ON a.sh = b.sh AND a.id < b.id GROUP BY 1, 2)
SELECT id_a, id_b, common, na.n + nb.n - common AS either FROM p JOIN n na ON na.id = id_a JOIN n nb ON nb.id = id_b WHERE 100 * common >= 80 * (na.n + nb.n - common)""")
def s02_fuzzy_duplicates(spark, sf_dir):
    return dedupe.fuzzy_pairs(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("SELECT sha256(text) AS content_hash, min(doc_id) AS kept_id, count(*) AS n_copies, string_agg(DISTINCT source, ',' ORDER BY source) AS origins FROM documents GROUP BY 1")
def s10_content_dedupe(spark, sf_dir):
    return dedupe.keep_first(table(spark, sf_dir, "documents"), F.sha2("text", 256), "doc_id", "source")


@query("""WITH e AS (SELECT c_name AS entity, ltrim(lower(replace(c_name, 'Customer#', ''))) AS name, c_nationkey AS place FROM customer UNION ALL SELECT s_name, ltrim(lower(replace(s_name, 'Supplier#', ''))), s_nationkey FROM supplier)
SELECT entity, min(entity) OVER (PARTITION BY name, place) AS resolved, count(*) OVER (PARTITION BY name, place) AS n_aliases,
  CASE WHEN count(*) OVER (PARTITION BY name, place) > 1 THEN 'resolved' WHEN count(*) OVER (PARTITION BY name) > 1 THEN 'review' ELSE 'single' END AS verdict FROM e""")
def s23_vendor_resolution(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("entity"), F.regexp_replace("c_name", "^Customer#", "").alias("name"), F.col("c_nationkey").alias("place"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("entity"), F.regexp_replace("s_name", "^Supplier#", "").alias("name"), F.col("s_nationkey").alias("place"))
    return dedupe.resolve_identities(c.unionByName(s))


FIRST, SECOND, THIRD = ("Northern Harbour Granite Silver Eastern Union Valley Summit".split(), "Bridge Paving Electric Timber Water Survey Glass Steel".split(), "Works Partners Group Services Supply".split())


def _aliases(spark, sf_dir):
    """Vendor records of suppliers: under a made-up name, some also with a legal form and in capitals, some misspelt; some with tax ids."""
    sup = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("place"))
    pick = lambda xs, i: F.element_at(F.array(*[F.lit(x) for x in xs]), (i + 1).cast("int"))
    k = F.col("k")
    one, two, three = pick(FIRST, k % 8), pick(SECOND, F.floor(k / 8) % 8), pick(THIRD, k % 5)
    name = F.concat_ws(" ", one, two, three)
    tax = F.when(k % 4 == 0, F.concat(F.lit("T"), k.cast("string")))
    told = lambda mark, name, tax: F.struct(F.concat(F.lit(mark), k.cast("string")).alias("entity"), name.alias("name"), tax.alias("tax_id"))
    own = F.array(told("S-", name, tax), told("T-", F.concat(F.upper(name), F.lit(", Inc.")), F.when(k % 6 == 0, F.concat(F.lit("T"), k.cast("string")))), told("U-", F.concat_ws(" ", one, F.substr(two, F.lit(1), F.length(two) - 1), three), F.lit(None).cast("string")))
    wanted = F.filter(own, lambda x: x["entity"].startswith("S-") | (x["entity"].startswith("T-") & (k % 3 == 0)) | (x["entity"].startswith("U-") & (k % 5 == 0)))
    return sup.select("place", F.explode(wanted).alias("x")).select("x.entity", "x.name", "place", "x.tax_id")


_LIST = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"


ALIASES = rf"""b AS (SELECT s_suppkey AS k, s_nationkey AS place, {_LIST(FIRST)}[s_suppkey % 8 + 1] AS w1, {_LIST(SECOND)}[(s_suppkey // 8) % 8 + 1] AS w2, {_LIST(THIRD)}[s_suppkey % 5 + 1] AS w3 FROM supplier),
e AS (SELECT 'S-' || k AS entity, lower(w1 || ' ' || w2 || ' ' || w3) AS norm, place, CASE WHEN k % 4 = 0 THEN 'T' || k END AS tax FROM b
  UNION ALL SELECT 'T-' || k, lower(w1 || ' ' || w2 || ' ' || w3), place, CASE WHEN k % 6 = 0 THEN 'T' || k END FROM b WHERE k % 3 = 0
  UNION ALL SELECT 'U-' || k, lower(w1 || ' ' || substr(w2, 1, length(w2) - 1) || ' ' || w3), place, NULL FROM b WHERE k % 5 = 0)"""


@query(rf"""WITH RECURSIVE {ALIASES},
c AS (SELECT norm, place, min(entity) AS id, string_split(norm, ' ') AS w FROM e GROUP BY 1, 2),
l AS (SELECT x.entity AS a, y.entity AS b FROM e x JOIN e y ON x.tax = y.tax UNION SELECT id, entity FROM e JOIN c USING (norm, place)
  UNION SELECT x.id, y.id FROM c x JOIN c y ON x.place = y.place AND x.id < y.id WHERE 2 * len(list_intersect(x.w, y.w)) >= len(x.w) + len(y.w) - len(list_intersect(x.w, y.w)) AND 100 * levenshtein(x.norm, y.norm) <= 15 * greatest(length(x.norm), length(y.norm))),
u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(entity, reach) AS (SELECT entity, entity FROM e UNION SELECT u.b, r.reach FROM r JOIN u ON u.a = r.entity WHERE r.reach < u.b),
m AS (SELECT entity, min(reach) AS label FROM r GROUP BY 1), p AS (SELECT e.*, label FROM e JOIN m USING (entity)),
n AS (SELECT label, count(*) AS n, count(DISTINCT tax) AS taxes FROM p GROUP BY 1), o AS (SELECT norm, count(*) AS places FROM c GROUP BY 1)
SELECT entity, CASE WHEN taxes > 1 THEN entity ELSE label END AS resolved, CASE WHEN taxes > 1 THEN 1 ELSE n END AS n_aliases, CASE WHEN taxes > 1 THEN 'review' WHEN n > 1 THEN 'resolved' WHEN places > 1 THEN 'review' ELSE 'single' END AS verdict
FROM p JOIN n USING (label) JOIN o USING (norm)""")
def s23_vendor_aliases(spark, sf_dir):
    """Records of vendors under several names."""
    return dedupe.resolve_vendors(_aliases(spark, sf_dir))


_ALIKE = "(2 * len(list_intersect(x.w, y.w)) >= len(x.w) + len(y.w) - len(list_intersect(x.w, y.w)) AND 100 * levenshtein(x.norm, y.norm) <= 15 * greatest(length(x.norm), length(y.norm)))"
_CHANCE = lambda c: f"(SELECT (sum(c * (c - 1) / 2) + 0.5) / (sum(c) * (sum(c) - 1) / 2 + 1) FROM (SELECT CAST(sum(n) AS DOUBLE) AS c FROM k WHERE {c} IS NOT NULL GROUP BY {c}))"
_EXPECTED = lambda f, levels: "[" + ", ".join(f"list_sum(list_transform(q, lambda x: CASE WHEN x.{f} = {v} THEN x.w ELSE 0 END)) + 0.5" for v in levels) + "]"
_SHARES = lambda c: f"list_transform({c}, lambda x: x / list_sum({c}))"
_LIKELY = lambda n, p, t: f"CASE WHEN x.name < 0 THEN 1 ELSE {n}[3 - x.name] END * CASE WHEN x.place < 0 THEN 1 ELSE {p}[2 - x.place] END * CASE WHEN x.tax < 0 THEN 1 ELSE {t}[2 - x.tax] END"
LINKS = f"""k AS MATERIALIZED (SELECT min(entity) AS id, norm, place, tax, count(DISTINCT entity) AS n, string_split(any_value(norm), ' ') AS w FROM e GROUP BY norm, place, tax),
r AS (SELECT norm, place, coalesce(min(id) FILTER (WHERE tax IS NULL), min(id)) AS id, any_value(w) AS w FROM k GROUP BY norm, place),
cand AS (SELECT h.id AS a, k.id AS b FROM k JOIN (SELECT tax, min(id) AS id FROM k WHERE tax IS NOT NULL GROUP BY tax) h USING (tax)
  UNION SELECT x.id, y.id FROM k x JOIN k y USING (norm, place) WHERE x.tax IS NULL AND y.tax IS NOT NULL
  UNION SELECT h.id, k.id FROM k JOIN (SELECT norm, min(id) AS id, arg_min(place, id) AS place FROM k WHERE tax IS NULL GROUP BY norm) h USING (norm) WHERE k.place <> h.place
  UNION SELECT x.id, y.id FROM r x JOIN r y ON x.place = y.place AND x.norm < y.norm AND {_ALIKE}),
lev AS MATERIALIZED (SELECT a, b, CASE WHEN x.norm = y.norm THEN 2 WHEN {_ALIKE} THEN 1 ELSE 0 END AS name, CASE WHEN x.place = y.place THEN 1 ELSE 0 END AS place, CASE WHEN x.tax IS NULL OR y.tax IS NULL THEN -1 WHEN x.tax = y.tax THEN 1 ELSE 0 END AS tax, CASE WHEN x.norm = y.norm THEN x.norm END AS norm, x.n * y.n AS n_pairs
  FROM (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM cand WHERE a <> b) JOIN k x ON x.id = a JOIN k y ON y.id = b),
ch AS (SELECT {_CHANCE("norm")} AS eq, (SELECT coalesce(sum(n_pairs) FILTER (WHERE name = 1 AND place = 1), 0) + 0.5 FROM lev) / ((SELECT sum(c * (c - 1) / 2) FROM (SELECT CAST(sum(n) AS DOUBLE) AS c FROM k GROUP BY place)) + 1) AS near, {_CHANCE("place")} AS pl, {_CHANCE("tax")} AS tx),
u AS MATERIALIZED (SELECT [eq, least(near, (1 - eq) / 2), 1 - eq - least(near, (1 - eq) / 2)] AS un, [pl, 1 - pl] AS up, [tx, 1 - tx] AS ut, (SELECT list({{'name': name, 'place': place, 'tax': tax, 'c': c}} ORDER BY name, place, tax) FROM (SELECT name, place, tax, count(*) AS c FROM lev GROUP BY ALL)) AS pats FROM ch),
em(it, mn, mp, mt, s) AS (SELECT 0, [0.6::DOUBLE, 0.3, 0.1], [0.9::DOUBLE, 0.1], [0.95::DOUBLE, 0.05], 0.5::DOUBLE
  UNION ALL SELECT it + 1, {_SHARES("gn")}, {_SHARES("gp")}, {_SHARES("gt")}, g / total FROM (SELECT it, {_EXPECTED("name", (2, 1, 0))} AS gn, {_EXPECTED("place", (1, 0))} AS gp, {_EXPECTED("tax", (1, 0))} AS gt, list_sum(list_transform(q, lambda x: x.w)) + 0.5 AS g, list_sum(list_transform(q, lambda x: x.c)) + 1 AS total
    FROM (SELECT it, list_transform(pats, lambda x: {{'name': x.name, 'place': x.place, 'tax': x.tax, 'c': x.c, 'w': x.c * s * {_LIKELY("mn", "mp", "mt")} / (s * {_LIKELY("mn", "mp", "mt")} + (1 - s) * {_LIKELY("un", "up", "ut")})}}) AS q FROM em, u WHERE it < 30))),
sc AS (SELECT x.*, log2({_LIKELY("mn", "mp", "mt")}) - log2({_LIKELY("un", "up", "ut")}) + CASE WHEN name = 2 THEN log2(un[1] * (SELECT sum(n) FROM k) / held) ELSE 0 END AS weight, log2(s / (1 - s)) AS odds
  FROM lev x LEFT JOIN (SELECT norm, sum(n) AS held FROM k GROUP BY norm) USING (norm), em, u WHERE it = 30),
pr AS (SELECT *, 1 / (1 + pow(2, -(weight + odds))) AS p FROM sc)"""


@query(f"""WITH RECURSIVE {ALIASES}, {LINKS}
SELECT a, b, name, place, tax, round(weight, 4) AS weight, round(p, 6) AS probability, concat_ws(',', CASE WHEN tax = 1 THEN 'tax_id' END, CASE name WHEN 2 THEN 'name' WHEN 1 THEN 'similar_name' END, CASE WHEN place = 1 THEN 'place' END) AS reason,
  CASE WHEN tax = 0 THEN 'no' WHEN (tax = 1 OR (name >= 1 AND place = 1)) AND p >= 0.95 THEN 'match' WHEN p >= 0.5 OR name = 2 THEN 'possible' ELSE 'no' END AS decision FROM pr""")
def s23_linkage_scores(spark, sf_dir):
    """The candidates among the records of s23_vendor_aliases, with weights fitted on them."""
    pairs = linkage.link(_aliases(spark, sf_dir))[1]
    return pairs.withColumns({"weight": F.round("weight", 4), "probability": F.round("probability", 6)})


# ---- metrics ----


def _labelled(spark, sf_dir):
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


@query("""WITH d AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)),
u AS (SELECT 'text' AS field, count(text) AS filled, count(*) AS total FROM d UNION ALL SELECT 'lang', count(lang), count(*) FROM d UNION ALL SELECT 'quality', count(quality), count(*) FROM d UNION ALL SELECT 'toxic', count(toxic), count(*) FROM d)
SELECT field, filled, total, round(filled / total, 6) AS share FROM u""")
def s04_completeness(spark, sf_dir):
    return metrics.completeness(_labelled(spark, sf_dir), ["text", "lang", "quality", "toxic"])


@query("SELECT event_type AS source, max(ts) AS latest, date_diff('day', CAST(max(ts) AS DATE), DATE '2025-01-01') AS age_days FROM events GROUP BY 1")
def s05_freshness(spark, sf_dir):
    return metrics.freshness(table(spark, sf_dir, "events"), "event_type", "ts", "2025-01-01")


@query("SELECT CASE WHEN event_type = 'error' THEN 'error ' || CAST(json_extract_string(props, '$.k') AS BIGINT) // 10 ELSE 'none' END AS reason, count(*) AS n FROM events GROUP BY 1")
def s06_failure_counts(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("long")
    return metrics.counts_by(table(spark, sf_dir, "events"), F.when(F.col("event_type") == "error", F.concat(F.lit("error "), F.floor(k / 10).cast("string"))).otherwise("none"))


@query("SELECT source, count(*) AS n, count(DISTINCT lang) AS n_langs, min(doc_id) AS first_id, max(doc_id) AS last_id, count(quality) AS n_labelled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source")
def s33_source_coverage(spark, sf_dir):
    return _labelled(spark, sf_dir).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("lang").alias("n_langs"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("quality").alias("n_labelled"))


@query("""WITH h AS (SELECT DISTINCT event_type AS source, date_trunc('hour', ts) AS gap_from FROM events), g AS (SELECT source, gap_from, lead(gap_from) OVER (PARTITION BY source ORDER BY gap_from) AS after FROM h)
SELECT source, gap_from, coalesce(after, TIMESTAMP '2025-01-01') AS gap_to, date_diff('hour', gap_from, coalesce(after, TIMESTAMP '2025-01-01')) AS hours, after IS NULL AS open FROM g WHERE date_diff('hour', gap_from, coalesce(after, TIMESTAMP '2025-01-01')) >= 3""")
def s33_source_gaps(spark, sf_dir):
    return metrics.source_gaps(table(spark, sf_dir, "events"), "event_type", "ts", 3, "2025-01-01")


@query("SELECT source AS grp, count(*) AS n, count(quality) AS n_ok, round(count(quality) / count(*), 6) AS rate, count(quality) >= 0.95 * count(*) AS passed FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def s36_acquisition_gate(spark, sf_dir):
    return metrics.gate(_labelled(spark, sf_dir), "source", F.col("quality").isNotNull(), 0.95)


@query("""WITH q AS (SELECT contains(text, '!!') OR contains(text, '$$$') AS said, quality = 0 AS bad FROM documents JOIN labels USING (doc_id)),
c AS (SELECT count(*) FILTER (WHERE said AND bad) AS tp, count(*) FILTER (WHERE said AND NOT bad) AS fp, count(*) FILTER (WHERE NOT said AND bad) AS fn FROM q)
SELECT tp, fp, fn, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall FROM c""")
def s37_extraction_quality(spark, sf_dir):
    met = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return metrics.quality(met, F.contains("text", F.lit("!!")) | F.contains("text", F.lit("$$$")), F.col("quality") == 0)


def _rules():
    return {"price_positive": F.col("o_totalprice") > 0, "price_below_400k": F.col("o_totalprice") < 400000, "status_known": F.col("o_orderstatus").isin("F", "O", "P"), "buyer_known": F.col("c_custkey").isNotNull()}


@query("""WITH o AS (SELECT orders.*, c_custkey FROM orders LEFT JOIN customer ON c_custkey = o_custkey)
SELECT 'price_positive' AS rule, count(*) AS checked, count(*) FILTER (WHERE NOT coalesce(o_totalprice > 0, false)) AS broken FROM o
UNION ALL SELECT 'price_below_400k', count(*), count(*) FILTER (WHERE NOT coalesce(o_totalprice < 400000, false)) FROM o
UNION ALL SELECT 'status_known', count(*), count(*) FILTER (WHERE NOT coalesce(o_orderstatus IN ('F', 'O', 'P'), false)) FROM o
UNION ALL SELECT 'buyer_known', count(*), count(*) FILTER (WHERE c_custkey IS NULL) FROM o""")
def s38_validation_report(spark, sf_dir):
    met = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select("c_custkey"), F.col("c_custkey") == F.col("o_custkey"), "left")
    return metrics.validation_report(met, _rules())


@query("""WITH o AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 13 = 0 THEN -o_totalprice ELSE o_totalprice END AS price, CASE WHEN o_orderkey % 17 = 0 THEN 'X' WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 23 = 0 THEN -1 ELSE o_custkey END AS buyer FROM orders)
SELECT id, 'price_positive' AS rule FROM o WHERE NOT coalesce(price > 0, false) UNION ALL SELECT id, 'price_below_400k' FROM o WHERE NOT coalesce(price < 400000, false)
UNION ALL SELECT id, 'status_known' FROM o WHERE NOT coalesce(status IN ('F', 'O', 'P'), false) UNION ALL SELECT id, 'buyer_known' FROM o WHERE buyer NOT IN (SELECT c_custkey FROM customer)""")
def s38_violations(spark, sf_dir):
    """Of orders to some of which every rule is broken."""
    k = F.col("o_orderkey")
    broken = table(spark, sf_dir, "orders").withColumns({"o_totalprice": F.when(k % 13 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice")), "o_orderstatus": F.when(k % 17 == 0, "X").when(k % 19 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")), "o_custkey": F.when(k % 23 == 0, -1).otherwise(F.col("o_custkey"))})
    met = broken.join(table(spark, sf_dir, "customer").select("c_custkey"), F.col("c_custkey") == F.col("o_custkey"), "left")
    return metrics.violations(met, "o_orderkey", _rules())


CONTRACTS = {
    "orders": {"key": ["o_orderkey"], "columns": {"o_orderkey": {"required": True}, "o_orderstatus": {"required": True, "enum": ["F", "O", "P"]}, "o_orderpriority": {"pattern": r"[1-5]-[A-Z ]+"}, "o_totalprice": {"required": True, "least": 0, "most": 400000}, "o_orderdate": {"format": "timestamp"}}, "unique": [["o_orderkey"]], "references": [{"columns": ["o_custkey"], "table": "customer", "to": ["c_custkey"]}]},
    "customer": {"key": ["c_custkey"], "columns": {"c_name": {"required": True, "pattern": r"Customer#\d{9}"}, "c_fax": {"pattern": r"\d+"}}, "unique": [["c_custkey"], ["c_name"]]},
}


@query("""WITH o AS (SELECT CASE WHEN o_orderkey % 29 = 0 THEN o_orderkey + 1 ELSE o_orderkey END AS k, CASE WHEN o_orderkey % 13 = 0 THEN -o_totalprice ELSE o_totalprice END AS price, CASE WHEN o_orderkey % 17 = 0 THEN 'X' WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 23 = 0 THEN -1 ELSE o_custkey END AS buyer,
  CASE WHEN o_orderkey % 31 = 0 THEN 'none' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END AS priority, CASE WHEN o_orderkey % 37 = 0 THEN '2020-13-45 00:00:00' ELSE '2020-01-02 00:00:00' END AS date FROM orders)
SELECT 'orders' AS "table", CAST(k AS VARCHAR) AS key, 'o_orderstatus' AS path, 'required' AS rule FROM o WHERE status IS NULL UNION ALL SELECT 'orders', CAST(k AS VARCHAR), 'o_orderstatus', 'enum' FROM o WHERE status NOT IN ('F', 'O', 'P')
UNION ALL SELECT 'orders', CAST(k AS VARCHAR), 'o_totalprice', 'least' FROM o WHERE price < 0 UNION ALL SELECT 'orders', CAST(k AS VARCHAR), 'o_totalprice', 'most' FROM o WHERE price > 400000
UNION ALL SELECT 'orders', CAST(k AS VARCHAR), 'o_orderpriority', 'pattern' FROM o WHERE NOT regexp_full_match(priority, '[1-5]-[A-Z ]+') UNION ALL SELECT 'orders', CAST(k AS VARCHAR), 'o_orderdate', 'format' FROM o WHERE date LIKE '2020-13%'
UNION ALL SELECT 'orders', CAST(k AS VARCHAR), 'o_orderkey', 'unique' FROM o WHERE k IN (SELECT k FROM o GROUP BY k HAVING count(*) > 1) UNION ALL SELECT 'orders', CAST(k AS VARCHAR), 'o_custkey', 'reference' FROM o WHERE buyer NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'customer', NULL, 'c_fax', 'missing_column'""")
def s38_contract_violations(spark, sf_dir):
    """Of orders that break every rule of a contract somewhere, and customers that lack a column."""
    k, c = F.col("o_orderkey"), F.col
    made = {"o_totalprice": F.when(k % 13 == 0, -c("o_totalprice")).otherwise(c("o_totalprice")), "o_orderstatus": F.when(k % 17 == 0, "X").when(k % 19 == 0, F.lit(None)).otherwise(c("o_orderstatus")), "o_custkey": F.when(k % 23 == 0, -1).otherwise(c("o_custkey")), "o_orderpriority": F.when(k % 31 == 0, "none").when(c("o_orderpriority") != "4-NOT SPECIFIED", c("o_orderpriority")), "o_orderdate": F.when(k % 37 == 0, "2020-13-45 00:00:00").otherwise("2020-01-02 00:00:00")}
    orders = table(spark, sf_dir, "orders").withColumns(made).withColumn("o_orderkey", F.when(k % 29 == 0, k + 1).otherwise(k))
    return contracts.validate({"orders": orders, "customer": table(spark, sf_dir, "customer")}, CONTRACTS)


@query("""SELECT 'events' AS gate, count(*) AS n, count(*) >= 30 AS passed FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'
UNION ALL SELECT 'observations', count(*), count(*) >= 100 FROM lineitem UNION ALL SELECT 'vendors', count(DISTINCT l_suppkey), count(DISTINCT l_suppkey) >= 25 FROM lineitem
UNION ALL SELECT 'held_out', count(*), count(*) >= 10 FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'""")
def s44_volume_gates(spark, sf_dir):
    old = F.col("date") < F.lit(CUTOFF).cast("timestamp")
    order, item = table(spark, sf_dir, "orders").withColumn("date", F.col("o_orderdate")), table(spark, sf_dir, "lineitem")
    a = order.agg(F.count_if(old).alias("events"), F.count_if(~old).alias("held_out"))
    b = item.agg(F.count(F.lit(1)).alias("observations"), F.count_distinct("l_suppkey").alias("vendors"))
    least = {"events": 30, "observations": 100, "vendors": 25, "held_out": 10}
    rows = [x.unpivot([], [c for c in x.columns], "gate", "n") for x in (a, b)]
    need = F.create_map(*[F.lit(v) for kv in least.items() for v in kv])[F.col("gate")]
    return rows[0].unionByName(rows[1]).withColumn("passed", F.col("n") >= need)


# ---- documents ----


@query(r"""WITH l AS (SELECT page_id, regexp_extract_all(html, '(?i)[\s"''/]href\s*=\s*(?:"[^"]*"|''[^'']*''|[^\s"''>]+)', 0) AS h FROM pages),
o AS (SELECT page_id, CAST(unnest(range(len(h))) AS BIGINT) AS pos, regexp_replace(regexp_replace(unnest(h), '(?i)^[\s"''/]href\s*=\s*', ''), '^["'']|["'']$', '', 'g') AS s FROM l)
SELECT page_id AS id, pos, replace(replace(replace(replace(replace(replace(replace(replace(s, '&quot;', '"'), '&#34;', '"'), '&apos;', ''''), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&#38;', '&'), '&amp;', '&') AS href FROM o""")
def s08_link_enumeration(spark, sf_dir):
    return documents.links(table(spark, sf_dir, "pages"), "page_id", "html")


@query("""WITH p AS (SELECT page_id, html, CASE WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 7 = 0 THEN 404 WHEN page_id % 5 = 0 THEN 204 ELSE 200 END AS status, CASE WHEN page_id % 13 = 0 THEN NULL WHEN page_id % 9 = 0 THEN 'application/pdf' WHEN page_id % 2 = 0 THEN 'Text/HTML; charset=utf-8' ELSE 'text/html' END AS kind FROM pages)
SELECT page_id, CASE WHEN coalesce(status NOT BETWEEN 200 AND 299, true) THEN 'bad_status' WHEN html IS NULL THEN 'missing' WHEN coalesce(lower(trim(split_part(kind, ';', 1))) <> 'text/html', true) THEN 'bad_content_type' WHEN strlen(html) < 1000 THEN 'too_small' WHEN strlen(html) > 10000 THEN 'too_large' WHEN lower(substr(html, 1, 9)) <> '<!doctype' THEN 'bad_signature' ELSE 'ok' END AS verdict FROM p""")
def s09_fetch_with_status(spark, sf_dir):
    """With statuses and content types by fixed rules, as the pages come without."""
    k = F.col("page_id")
    status = F.when(k % 11 == 0, F.lit(None)).when(k % 7 == 0, 404).when(k % 5 == 0, 204).otherwise(200)
    kind = F.when(k % 13 == 0, F.lit(None)).when(k % 9 == 0, "application/pdf").when(k % 2 == 0, "Text/HTML; charset=utf-8").otherwise("text/html")
    return table(spark, sf_dir, "pages").select("page_id", documents.fetch_verdict(F.col("html"), 1000, 10000, "<!doctype", status, kind).alias("verdict"))


@query("""SELECT page_id, CASE WHEN html IS NULL THEN 'missing' WHEN strlen(html) < 1000 THEN 'too_small' WHEN strlen(html) > 10000 THEN 'too_large' WHEN lower(substr(html, 1, 9)) <> '<!doctype' THEN 'bad_signature' ELSE 'ok' END AS verdict FROM pages""")
def s09_fetch_validation(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", documents.fetch_verdict(F.col("html"), 1000, 10000, "<!doctype").alias("verdict"))


@query("SELECT coalesce(CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END, 'not_attempted') AS reason, count(*) AS n FROM (SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)) WHERE quality IS NOT NULL GROUP BY 1 UNION ALL SELECT 'not_attempted', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def s11_outcomes(spark, sf_dir):
    said = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("poor").alias("outcome"))
    return metrics.counts_by(documents.with_outcomes(table(spark, sf_dir, "documents"), said, "doc_id", "outcome"), F.col("status"))


@query("SELECT d.doc_id, source, sha256(text) AS sha256, n_chars, CASE WHEN l.doc_id IS NULL THEN 'not_attempted' ELSE 'processed' END AS status FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def s14_manifest(spark, sf_dir):
    """Written as JSON lines and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("sha256"), "n_chars")
    rows = documents.with_outcomes(docs, table(spark, sf_dir, "labels").select("doc_id", F.lit("processed").alias("state")), "doc_id", "state").drop("state")
    path = Scratch(spark, "manifest").path("lines")
    write_jsonl(rows, path)
    return spark.read.schema("doc_id long, source string, sha256 string, n_chars long, status string").json(path)


@query("SELECT doc_id AS id, CAST(unnest(range(len(string_split(text, chr(10))))) + 1 AS BIGINT) AS page_no, sha256(unnest(string_split(text, chr(10)))) AS page_hash FROM documents")
def s13_page_texts(spark, sf_dir):
    return documents.page_texts(table(spark, sf_dir, "documents"), "doc_id", "text").select("id", "page_no", F.sha2("text", 256).alias("page_hash"))


@query("""WITH a AS (SELECT doc_id AS id, list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT item_id AS id, list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda w: w <> '') AS w FROM benchmark),
ra AS (SELECT DISTINCT id, unnest(list_transform(range(1, greatest(1, len(w) - 6)), lambda i: array_to_string(w[i:i+7], ' '))) AS run FROM a),
rb AS (SELECT DISTINCT id, unnest(list_transform(range(1, greatest(1, len(w) - 6)), lambda i: array_to_string(w[i:i+7], ' '))) AS run FROM b)
SELECT ra.id AS doc_id, rb.id AS item_id, count(*) AS hits FROM ra JOIN rb USING (run) GROUP BY 1, 2""")
def s17_reference_mining(spark, sf_dir):
    return documents.references(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text")


@query(r"""WITH b AS (SELECT item_id AS item, string_split(lower(replace(text, chr(10), ' ')), ' ') AS w FROM benchmark),
k AS (SELECT DISTINCT item, unnest([array_to_string(w[1:3], ' '), array_to_string(w[2:3], ' '), array_to_string(w[2:6], ' ')]) AS matched FROM b),
d AS (SELECT doc_id, CAST(unnest(range(len(string_split(text, chr(10))))) + 1 AS BIGINT) AS page_no, lower(unnest(string_split(text, chr(10)))) AS text FROM documents),
f AS (SELECT DISTINCT matched FROM k WHERE matched <> ''),
h AS (SELECT doc_id, page_no, matched, text, unnest(list_filter(range(1, length(text) - length(matched) + 2), lambda i: substr(text, i, length(matched)) = matched)) AS position FROM d JOIN f ON contains(text, matched))
SELECT doc_id, page_no, CAST(position AS BIGINT) AS position, item, k.matched FROM h JOIN k USING (matched)
WHERE NOT (regexp_matches(substr(text, position - 1, CASE WHEN position > 1 THEN 1 ELSE 0 END), '[\p{L}\p{N}]') AND regexp_matches(substr(k.matched, 1, 1), '[\p{L}\p{N}]'))
AND NOT (regexp_matches(substr(text, position + length(k.matched), 1), '[\p{L}\p{N}]') AND regexp_matches(right(k.matched, 1), '[\p{L}\p{N}]'))""")
def s17_mentions(spark, sf_dir):
    """Where the first words of known items, in three overlapping patterns each, stand in the pages of documents."""
    words = F.split(F.lower(F.translate("text", "\n", " ")), " ")
    run = lambda start, n: F.array_join(F.slice("w", start, n), " ")
    known = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), words.alias("w")).select("id", F.explode(F.array(run(1, 3), run(2, 2), run(2, 5))).alias("pattern"))
    pages = documents.page_texts(table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")
    return documents.mentions(pages, ["doc_id", "page_no"], "text", known, "id", "pattern")


@query("SELECT doc_id, quality, doc_id IN (SELECT min(doc_id) FROM documents GROUP BY sha256(text)) AS cited FROM labels")
def s49_evidence_integrity(spark, sf_dir):
    """Evidence is the first copy of each content."""
    kept = dedupe.keep_first(table(spark, sf_dir, "documents"), F.sha2("text", 256), "doc_id", "source").select(F.col("kept_id").alias("doc_id"))
    return documents.cited(table(spark, sf_dir, "labels").select("doc_id", "quality"), kept, "doc_id")


# ---- lineage ----


@query("""SELECT o_custkey AS parent, o_orderkey AS record, row_number() OVER w AS version, first_value(o_orderkey) OVER w AS original,
  last_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS latest
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def s03_amendment_latest(spark, sf_dir):
    return lineage.amendments(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderkey")


@query("""WITH p AS (SELECT a.o_orderkey AS record, b.o_orderkey AS predecessor, a.o_orderpriority = b.o_orderpriority AS pr, a.o_orderstatus = b.o_orderstatus AS st,
  date_diff('day', CAST(b.o_orderdate AS DATE), CAST(a.o_orderdate AS DATE)) AS d, abs(a.o_totalprice - b.o_totalprice) <= 0.1 * a.o_totalprice AS am
  FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey),
s AS (SELECT *, CAST(CASE WHEN pr THEN 2 ELSE 0 END + CASE WHEN st THEN 1 ELSE 0 END + CASE WHEN d <= 90 THEN 1 ELSE 0 END + CASE WHEN am THEN 2 ELSE 0 END AS BIGINT) AS score FROM p WHERE d > 0 AND d <= 365)
SELECT record, predecessor, score, concat_ws(',', CASE WHEN pr THEN 'priority' END, CASE WHEN st THEN 'status' END, CASE WHEN d <= 90 THEN 'near' END, CASE WHEN am THEN 'amount' END) AS signals FROM s WHERE score >= 3""")
def s16_lineage_score(spark, sf_dir):
    c = F.col
    signals = {"priority": (2, c("a_o_orderpriority") == c("b_o_orderpriority")), "status": (1, c("a_o_orderstatus") == c("b_o_orderstatus")), "near": (1, F.datediff("a_o_orderdate", "b_o_orderdate") <= 90), "amount": (2, F.abs(c("a_o_totalprice") - c("b_o_totalprice")) <= 0.1 * c("a_o_totalprice"))}
    return lineage.scored_links(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderkey", "o_orderdate", signals, 3, 365)


@query("""WITH o AS (SELECT orders.*, c_nationkey AS place, c_mktsegment AS segment, c_nationkey || '/' || CAST(floor(o_totalprice / 100) AS BIGINT) AS place_amount, c_mktsegment || '/' || CAST(floor(o_totalprice / 20) AS BIGINT) AS segment_amount FROM orders JOIN customer ON c_custkey = o_custkey),
p AS (SELECT a.o_orderkey AS record, b.o_orderkey AS predecessor, a.o_custkey = b.o_custkey AS bu, a.place = b.place AS pl, a.segment = b.segment AS se, a.o_orderpriority = b.o_orderpriority AS pr, date_diff('day', CAST(b.o_orderdate AS DATE), CAST(a.o_orderdate AS DATE)) AS d, abs(a.o_totalprice - b.o_totalprice) <= 0.1 * a.o_totalprice AS am
  FROM o a JOIN o b ON a.o_custkey = b.o_custkey OR a.place_amount = b.place_amount OR a.segment_amount = b.segment_amount),
s AS (SELECT *, CAST(CASE WHEN bu THEN 3 ELSE 0 END + CASE WHEN pl THEN 1 ELSE 0 END + CASE WHEN se THEN 1 ELSE 0 END + CASE WHEN pr THEN 2 ELSE 0 END + CASE WHEN am THEN 2 ELSE 0 END AS BIGINT) AS score FROM p WHERE d > 0 AND d <= 365)
SELECT record, predecessor, score, concat_ws(',', CASE WHEN bu THEN 'buyer' END, CASE WHEN pl THEN 'place' END, CASE WHEN se THEN 'segment' END, CASE WHEN pr THEN 'priority' END, CASE WHEN am THEN 'amount' END) AS signals FROM s WHERE score >= 5""")
def s16_lineage_by_any_signal(spark, sf_dir):
    """Candidates by buyer, by place and amount, or by segment and amount."""
    c, band = F.col, lambda by: F.floor(F.col("o_totalprice") / by).cast("string")
    met = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    met = met.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority", c("c_nationkey").alias("place"), c("c_mktsegment").alias("segment"), F.concat_ws("/", c("c_nationkey").cast("string"), band(100)).alias("place_amount"), F.concat_ws("/", "c_mktsegment", band(20)).alias("segment_amount"))
    same = lambda x: c(f"a_{x}") == c(f"b_{x}")
    signals = {"buyer": (3, same("o_custkey")), "place": (1, same("place")), "segment": (1, same("segment")), "priority": (2, same("o_orderpriority")), "amount": (2, F.abs(c("a_o_totalprice") - c("b_o_totalprice")) <= 0.1 * c("a_o_totalprice"))}
    return lineage.scored_links(met, ["o_custkey", "place_amount", "segment_amount"], "o_orderkey", "o_orderdate", signals, 5, 365)


@query("""WITH RECURSIVE e AS (SELECT o_orderkey AS node, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS parent FROM orders),
r(node, root, depth) AS (SELECT node, node, 0 FROM e WHERE parent IS NULL UNION ALL SELECT e.node, r.root, r.depth + 1 FROM r JOIN e ON e.parent = r.node)
SELECT node, root, CAST(depth AS BIGINT) AS depth FROM r""")
def s18_lineage_chain(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return lineage.chains(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("node"), F.lag("o_orderkey").over(w).alias("parent")))


@query("""WITH RECURSIVE p AS (SELECT a.o_orderkey AS node, b.o_orderkey AS parent, CASE WHEN a.o_orderpriority = b.o_orderpriority THEN 2 ELSE 0 END + CASE WHEN a.o_orderstatus = b.o_orderstatus THEN 1 ELSE 0 END + CASE WHEN date_diff('day', CAST(b.o_orderdate AS DATE), CAST(a.o_orderdate AS DATE)) <= 90 THEN 1 ELSE 0 END + CASE WHEN abs(a.o_totalprice - b.o_totalprice) <= 0.1 * a.o_totalprice THEN 2 ELSE 0 END AS score
  FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey WHERE date_diff('day', CAST(b.o_orderdate AS DATE), CAST(a.o_orderdate AS DATE)) BETWEEN 1 AND 365),
e AS MATERIALIZED (SELECT node, parent, round(score / 6, 9) AS c FROM p WHERE score >= 3),
r(node, ancestor, confidence, hops) AS (SELECT node, parent, c, 1 FROM e UNION SELECT r.node, e.parent, round(r.confidence * e.c, 9), hops + 1 FROM r JOIN e ON e.node = r.ancestor),
m AS (SELECT node, ancestor, max({'c': confidence, 'h': -hops}) AS best FROM r GROUP BY 1, 2)
SELECT node, ancestor, best.c AS confidence, CAST(-best.h AS BIGINT) AS hops, ancestor IN (SELECT node FROM e) AS known FROM m""")
def s18_lineage_closure(spark, sf_dir):
    """All predecessors over any number of the links of s16, with the confidence of the best way."""
    links = s16_lineage_score(spark, sf_dir)
    return lineage.closure(links.select(F.col("record").alias("node"), F.col("predecessor").alias("parent"), (F.col("score") / 6).alias("confidence")))


@query("""SELECT c_custkey AS target, 'orders' AS sources, '1995-01-01/1995-06-30' AS date_range, 'no match in searched sources' AS result FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1995-07-01')""")
def s19_no_match_trace(spark, sf_dir):
    window = table(spark, sf_dir, "orders").where("o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1995-07-01'")
    return lineage.no_match_trace(table(spark, sf_dir, "customer"), "c_custkey", window, "o_custkey", {"sources": "orders", "date_range": "1995-01-01/1995-06-30"})


@query("""WITH v AS (SELECT o_orderkey AS record, lag(o_orderkey) OVER w AS predecessor, o_orderstatus AS s, lag(o_orderstatus) OVER w AS s0, o_orderpriority AS p, lag(o_orderpriority) OVER w AS p0 FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))
SELECT record, predecessor, 'status' AS field, s0 AS old, s AS new FROM v WHERE predecessor IS NOT NULL AND s IS DISTINCT FROM s0
UNION ALL SELECT record, predecessor, 'priority', p0, p FROM v WHERE predecessor IS NOT NULL AND p IS DISTINCT FROM p0""")
def s48_predecessor_diff(spark, sf_dir):
    return lineage.version_changes(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderkey", {"status": F.col("o_orderstatus"), "priority": F.col("o_orderpriority")})


@query(f"""WITH {BIDS}, w AS (SELECT o_orderkey AS record, lag(o_orderkey) OVER o AS predecessor, CAST(o_orderdate AS DATE) AS d, CAST(lag(o_orderdate) OVER o AS DATE) AS d0, CAST(o_totalprice AS DECIMAL(18,2)) AS a, CAST(lag(o_totalprice) OVER o AS DECIMAL(18,2)) AS a0 FROM orders WINDOW o AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
i AS (SELECT event, list(DISTINCT commodity) AS scope FROM bids GROUP BY 1)
SELECT record, predecessor, date_diff('day', d0, d) AS days_later, CAST(a - a0 AS DOUBLE) AS amount_change, array_to_string(list_sort(list_filter(coalesce(x.scope, []), lambda c: NOT list_contains(coalesce(y.scope, []), c))), ',') AS scope_added,
  array_to_string(list_sort(list_filter(coalesce(y.scope, []), lambda c: NOT list_contains(coalesce(x.scope, []), c))), ',') AS scope_removed
FROM w LEFT JOIN i x ON x.event = record LEFT JOIN i y ON y.event = predecessor WHERE predecessor IS NOT NULL""")
def s48_scope_dates_amounts(spark, sf_dir):
    """What each order changed against its predecessor: its date, amount and scope, the commodities of its bids."""
    order = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record"), F.col("o_custkey").alias("parent"), F.to_date("o_orderdate").alias("date"), bidding.money("o_totalprice").alias("amount"), "o_orderdate")
    scope = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("record"), F.col("l_partkey").alias("item"))
    return lineage.field_changes(order, "parent", ["o_orderdate", "record"], "record", "date", "amount", scope)


def s48_text_changes(spark, sf_dir):
    """Runs of words that near copies of documents keep, delete and insert; pairs are those of s02.  SQL has no longest common subsequence: a test compares with brute force."""
    docs = dedupe.near_texts(table(spark, sf_dir, "documents"), "doc_id", "text")
    pairs = dedupe.pairs_among(docs, "doc_id", "text").select(F.col("id_a").alias("old"), F.col("id_b").alias("new"))
    pairs = Scratch(spark, "pairs", sent=False, kept=False).save(pairs, "pairs")
    return differences.text_changes(pairs, docs, "doc_id", "text").select("old", "new", "run", "change", "old_from", "old_to", "new_from", "new_to", F.sha2("said", 256).alias("said_sha256"))


QUERIES["s48_text_changes"] = s48_text_changes

# ---- participation and profiles ----

ROLE = {"A": "awardee", "R": "respondent"}


@query("""SELECT l_orderkey AS event, l_suppkey AS vendor, CASE l_returnflag WHEN 'A' THEN 'awardee' WHEN 'R' THEN 'respondent' ELSE 'unknown' END AS participation, l_extendedprice AS amount, o_orderdate AS event_date, 'observed' AS evidence
FROM lineitem JOIN orders ON o_orderkey = l_orderkey UNION ALL SELECT o_orderkey, NULL, 'planholder', NULL, o_orderdate, 'derived' FROM orders WHERE o_orderstatus = 'P'""")
def s20_bidder_events(spark, sf_dir):
    order = table(spark, sf_dir, "orders")
    role = F.create_map(*[F.lit(x) for kv in ROLE.items() for x in kv])
    seen = table(spark, sf_dir, "lineitem").join(order, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_orderkey").alias("event"), F.col("l_suppkey").alias("vendor"), F.coalesce(F.try_element_at(role, F.col("l_returnflag")), F.lit("unknown")).alias("participation"), F.col("l_extendedprice").alias("amount"), F.col("o_orderdate").alias("event_date"), F.lit("observed").alias("evidence"))
    held = order.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("event"), F.lit("planholder").alias("participation"), F.col("o_orderdate").alias("event_date"), F.lit("derived").alias("evidence"))
    return seen.unionByName(held, allowMissingColumns=True)


@query("SELECT CASE l_returnflag WHEN 'A' THEN 'awardee' WHEN 'R' THEN 'respondent' ELSE 'unknown' END AS reason, count(*) AS n FROM lineitem GROUP BY 1")
def s21_participation_counts(spark, sf_dir):
    role = F.create_map(*[F.lit(x) for kv in ROLE.items() for x in kv])
    return metrics.counts_by(table(spark, sf_dir, "lineitem"), F.coalesce(F.try_element_at(role, F.col("l_returnflag")), F.lit("unknown")))


@query(f"""WITH {BIDS} SELECT vendor, count(*) AS n_bids, count(*) FILTER (WHERE won) AS n_wins, CAST(sum(CAST(amount AS DECIMAL(18,2))) FILTER (WHERE won) AS DOUBLE) AS won_value, median(amount) AS typical_amount,
  min(date) AS first_seen, max(date) AS last_seen, count(DISTINCT buyer) AS n_buyers, string_agg(DISTINCT category, ',' ORDER BY category) AS categories, count(*) FILTER (WHERE NOT won) AS n_losses FROM bids GROUP BY vendor""")
def s24_vendor_profiles(spark, sf_dir):
    return bidding.vendor_profiles(stored(awarded(spark, sf_dir).select("vendor", "buyer", "won", "amount", "date", "category"), "bids"))


@query(f"""WITH {BIDS}, p AS (SELECT vendor, buyer, count(*) AS n, count(*) FILTER (WHERE won) AS wins, min(date) AS first, max(date) AS last FROM bids GROUP BY 1, 2),
j AS (SELECT vendor, string_agg(DISTINCT CAST(c_nationkey AS VARCHAR), ',' ORDER BY lpad(CAST(c_nationkey AS VARCHAR), 9, '0')) AS jurisdictions FROM (SELECT DISTINCT vendor, c_nationkey FROM bids JOIN customer ON c_custkey = buyer) GROUP BY 1),
o AS (SELECT vendor, sum(n) AS n, sum(wins) AS wins, greatest(date_diff('day', CAST(min(first) AS DATE), CAST(max(last) AS DATE)), 365) / 365 AS years, count(*) AS n_agencies, arg_max(buyer, (n, -buyer)) AS main_agency, max(n) AS of_main FROM p GROUP BY 1)
SELECT vendor, round(n / years, 6) AS bids_per_year, n_agencies, main_agency, round(of_main / n, 6) AS main_share, jurisdictions, round(wins / n, 6) AS win_rate, CASE WHEN wins / n >= 0.2 THEN 'prime' WHEN wins > 0 THEN 'occasional_prime' ELSE 'bidder' END AS likely_role FROM o JOIN j USING (vendor)""")
def s24_vendor_activity(spark, sf_dir):
    b = awarded(spark, sf_dir).select("vendor", "buyer", "date", "won").join(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("place")), F.col("buyer") == F.col("c_custkey"), "left")
    return bidding.vendor_activity(stored(b.drop("c_custkey"), "bids"))


@query("SELECT l_orderkey AS event, count(DISTINCT l_suppkey) AS n_known FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1")
def s25_known_bidders(spark, sf_dir):
    official = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    known = table(spark, sf_dir, "lineitem").join(official, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    return known.groupBy(F.col("l_orderkey").alias("event")).agg(F.count_distinct("l_suppkey").alias("n_known"))


@query(f"""WITH {BIDS} SELECT buyer, arg_max(vendor, (date, event)) AS incumbent, max(date) AS awarded FROM bids WHERE won AND date < TIMESTAMP '{CUTOFF}' GROUP BY buyer""")
def s28_incumbent_asof(spark, sf_dir):
    return bidding.incumbents(awarded(spark, sf_dir), CUTOFF)


@query(f"""WITH {BIDS}, e AS (SELECT o_orderkey AS event, o_custkey AS buyer, o_orderdate AS date FROM orders),
d AS (SELECT buyer, date, arg_max(vendor, (event, vendor)) AS incumbent, count(*) AS n, sum(CAST(amount AS DECIMAL(18,2))) AS v FROM bids WHERE won GROUP BY 1, 2),
c AS (SELECT buyer, date, incumbent, sum(n) OVER w AS n, sum(v) OVER w AS v FROM d WINDOW w AS (PARTITION BY buyer ORDER BY date))
SELECT e.event, e.buyer, e.date, c.incumbent, c.date AS awarded, CAST(coalesce(c.n, 0) AS BIGINT) AS n_awards, CAST(coalesce(c.v, 0) AS DOUBLE) AS awarded_value FROM e ASOF LEFT JOIN c ON e.buyer = c.buyer AND e.date > c.date""")
def s28_incumbent_at_event(spark, sf_dir):
    """For every order, as its buyer stood before it."""
    events = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event"), F.col("o_custkey").alias("buyer"), F.col("o_orderdate").alias("date"))
    return bidding.incumbents_at_events(stored(awarded(spark, sf_dir).select("buyer", "date", "event", "vendor", "amount", "won"), "bids"), events)


@query(f"""WITH {BIDS},
v AS (SELECT vendor, date, sum(count(*)) OVER w AS n, sum(count(*) FILTER (WHERE won)) OVER w AS wins FROM bids GROUP BY vendor, date WINDOW w AS (PARTITION BY vendor ORDER BY date)),
p AS (SELECT vendor, buyer, date, sum(count(*)) OVER w AS n, sum(count(*) FILTER (WHERE won)) OVER w AS wins FROM bids GROUP BY vendor, buyer, date WINDOW w AS (PARTITION BY vendor, buyer ORDER BY date)),
i AS (SELECT buyer, date, arg_max(vendor, (event, vendor)) AS incumbent FROM bids WHERE won GROUP BY 1, 2)
SELECT b.event, b.vendor, b.line, b.commodity, b.won, CAST(coalesce(v.n, 0) AS BIGINT) AS vendor_bids, CAST(coalesce(v.wins, 0) AS BIGINT) AS vendor_wins, CAST(coalesce(p.n, 0) AS BIGINT) AS pair_bids, CAST(coalesce(p.wins, 0) AS BIGINT) AS pair_wins,
  date_diff('day', CAST(v.date AS DATE), CAST(b.date AS DATE)) AS vendor_idle_days, date_diff('day', CAST(p.date AS DATE), CAST(b.date AS DATE)) AS pair_idle_days, i.incumbent, i.incumbent = b.vendor AS is_incumbent
FROM bids b ASOF LEFT JOIN v ON b.vendor = v.vendor AND b.date > v.date ASOF LEFT JOIN p ON b.vendor = p.vendor AND b.buyer = p.buyer AND b.date > p.date ASOF LEFT JOIN i ON b.buyer = i.buyer AND b.date > i.date""")
def s26_features_at_bids(spark, sf_dir):
    """For every bid, from before its day only."""
    b = stored(awarded(spark, sf_dir).select("event", "vendor", "buyer", "date", "won", "line", "commodity"), "bids")
    return bidding.features_at_bids(b).drop("buyer", "date")


@query(f"""WITH {BIDS}, a AS (SELECT event, vendor, sum(CAST(amount AS DECIMAL(18,2))) AS a FROM bids GROUP BY 1, 2), s AS (SELECT event, pow(CAST(a AS DOUBLE) / CAST(sum(a) OVER (PARTITION BY event) AS DOUBLE), 2) AS s2 FROM a)
SELECT event, count(*) AS n_bidders, round(sum(s2), 6) AS concentration FROM s GROUP BY event""")
def s29_intensity(spark, sf_dir):
    return bidding.intensity(bids(spark, sf_dir))


@query(f"""WITH {BIDS}, a AS (SELECT c_nationkey AS agency, vendor, sum(CAST(amount AS DECIMAL(18,2))) AS a FROM bids JOIN customer ON c_custkey = buyer GROUP BY 1, 2)
SELECT agency, vendor, CAST(a AS DOUBLE) AS spent, round(CAST(a AS DOUBLE) / CAST(sum(a) OVER (PARTITION BY agency) AS DOUBLE), 6) AS share FROM a""")
def s47_agency_share(spark, sf_dir):
    met = bids(spark, sf_dir).join(table(spark, sf_dir, "customer"), F.col("buyer") == F.col("c_custkey"))
    one = met.groupBy(F.col("c_nationkey").alias("agency"), "vendor").agg(F.sum(bidding.money("amount")).alias("a"))
    total = F.sum("a").over(Window.partitionBy("agency"))
    return one.select("agency", "vendor", F.col("a").cast("double").alias("spent"), F.round(F.try_divide(F.col("a").cast("double"), total.cast("double")), 6).alias("share"))


def _awards(spark, sf_dir):
    met = awarded(spark, sf_dir).where("won").join(table(spark, sf_dir, "customer"), F.col("buyer") == F.col("c_custkey"))
    return met.select(F.col("c_nationkey").alias("agency"), "vendor", "date", "amount")


MONTHLY = f"{BIDS}, m AS (SELECT c_nationkey AS agency, vendor, CAST(year(date) * 12 + month(date) - 1 AS INT) AS month, sum(CAST(amount AS DECIMAL(18,2))) AS spent, count(*) AS n FROM bids JOIN customer ON c_custkey = buyer WHERE won GROUP BY ALL)"


@query(f"""WITH {MONTHLY} SELECT CASE WHEN grouping(month) + grouping(agency) + grouping(vendor) = 3 THEN 'all' ELSE concat_ws(',', CASE WHEN grouping(month) = 0 THEN 'month' END, CASE WHEN grouping(agency) = 0 THEN 'agency' END, CASE WHEN grouping(vendor) = 0 THEN 'vendor' END) END AS level,
  month, agency, vendor, CAST(sum(spent) AS DOUBLE) AS spent, CAST(sum(n) AS BIGINT) AS n FROM m GROUP BY GROUPING SETS ((month, agency, vendor), (month, agency), (month), (agency, vendor), (agency), ())""")
def s47_spend_rollup(spark, sf_dir):
    return spend.rollup(spend.monthly(_awards(spark, sf_dir)))


@query(f"""WITH {MONTHLY}, c AS (SELECT agency, CAST(unnest(range(min(month), (SELECT max(month) + 1 FROM m))) AS INT) AS month FROM m GROUP BY 1),
v AS (SELECT c.agency, c.month, m.vendor, CAST(sum(m.spent) AS DOUBLE) AS v FROM c JOIN m ON m.agency = c.agency AND m.month BETWEEN c.month - 11 AND c.month GROUP BY ALL),
y AS (SELECT agency, month, sum(v) AS spent_year, count(*) AS n_vendors, sum(v * v) AS squares FROM v GROUP BY ALL)
SELECT c.agency, c.month, round(coalesce(spent_year, 0), 2) AS spent_year, coalesce(n_vendors, 0) AS n_vendors, round(squares / nullif(spent_year * spent_year, 0), 6) AS concentration FROM c LEFT JOIN y USING (agency, month)""")
def s47_trailing_concentration(spark, sf_dir):
    return spend.trailing_years(spend.monthly(_awards(spark, sf_dir)))


@query(f"WITH {BIDS} SELECT event, vendor, line, amount, rank() OVER (PARTITION BY event ORDER BY amount) AS bid_rank FROM bids")
def s52_bid_rank(spark, sf_dir):
    return bids(spark, sf_dir).select("event", "vendor", "line", "amount", F.rank().over(Window.partitionBy("event").orderBy("amount")).cast("long").alias("bid_rank"))


# ---- predictions ----

LIKELY = f"""{BIDS}, h AS (SELECT buyer, vendor, 3 * least(count(*), 5) AS same_buyer, 5 * least(count(*) FILTER (WHERE won), 5) AS same_buyer_wins, 2 * max(CASE WHEN date >= TIMESTAMP '{CUTOFF}' - INTERVAL 365 DAYS THEN 1 ELSE 0 END) AS recent FROM bids WHERE date < TIMESTAMP '{CUTOFF}' GROUP BY 1, 2),
r AS (SELECT *, same_buyer + same_buyer_wins + recent AS score, row_number() OVER (PARTITION BY buyer ORDER BY same_buyer + same_buyer_wins + recent DESC, vendor) AS place FROM h),
likely AS (SELECT e.event, r.vendor, r.same_buyer, r.same_buyer_wins, CAST(r.recent AS BIGINT) AS recent, CAST(r.score AS BIGINT) AS score, r.place FROM (SELECT DISTINCT event, buyer FROM bids WHERE date >= TIMESTAMP '{CUTOFF}') e JOIN r ON r.buyer = e.buyer WHERE r.place <= 5)"""


def _likely(spark, sf_dir):
    return bidding.likely_bidders(awarded(spark, sf_dir), CUTOFF)


@query(f"WITH {LIKELY} SELECT * FROM likely")
def s26_likely_bidders(spark, sf_dir):
    return _likely(spark, sf_dir)


@query(f"""WITH {LIKELY} SELECT event, vendor, concat_ws(',', CASE WHEN same_buyer > 0 THEN 'same_buyer' END, CASE WHEN same_buyer_wins > 0 THEN 'same_buyer_wins' END, CASE WHEN recent > 0 THEN 'recent' END) AS supporting,
  concat_ws(',', CASE WHEN same_buyer = 0 THEN 'same_buyer' END, CASE WHEN same_buyer_wins = 0 THEN 'same_buyer_wins' END, CASE WHEN recent = 0 THEN 'recent' END) AS weakening FROM likely""")
def s31_factors(spark, sf_dir):
    return bidding.factors(_likely(spark, sf_dir))


@query(f"""WITH {BIDS}, i AS (SELECT DISTINCT event, commodity FROM bids), n AS (SELECT event, count(*) AS n FROM i GROUP BY 1),
m AS (SELECT a.event, i.event AS other, count(*) AS common FROM i a JOIN i ON i.commodity = a.commodity AND i.event <> a.event GROUP BY 1, 2),
s AS (SELECT m.*, x.n + y.n - common AS either FROM m JOIN n x ON x.event = m.event JOIN n y ON y.event = m.other),
r AS (SELECT *, row_number() OVER (PARTITION BY event ORDER BY (common / either) DESC, other) AS place FROM s)
SELECT event, other AS similar, common, either, place FROM r WHERE place <= 3""")
def s27_similar_events(spark, sf_dir):
    """For every event."""
    b = stored(bids(spark, sf_dir).select("event", "commodity").distinct(), "items")
    return bidding.similar_events(b, b.select("event").distinct())


SCOPE = ("ECONOMY", "PROMO")
IN_SCOPE = "category IN ('ECONOMY', 'PROMO')"
PRIMES = f"""f AS (SELECT vendor, count(*) FILTER (WHERE won) AS n_wins, count(DISTINCT buyer) AS n_buyers, max(date) AS last_seen, median(amount) AS typical_amount, count(*) FILTER (WHERE won AND {IN_SCOPE}) AS scope_wins,
  coalesce(bool_or(won AND category = 'ECONOMY'), false) AS economy, coalesce(bool_or(won AND category = 'PROMO'), false) AS promo FROM bids GROUP BY vendor),
most AS (SELECT vendor, max(n) AS most FROM (SELECT vendor, buyer, count(*) AS n FROM bids WHERE won GROUP BY 1, 2) GROUP BY 1),
known AS (SELECT f.*, coalesce(most, 0) AS most FROM f LEFT JOIN most USING (vendor)),
told AS (SELECT vendor, (n_wins >= 10)::INT + (scope_wins >= 5)::INT + (most >= 2)::INT + (n_buyers >= 50)::INT + (last_seen >= TIMESTAMP '2001-01-01')::INT + (typical_amount >= 30000)::INT AS n_evidence,
  concat_ws(',', CASE WHEN n_wins >= 10 THEN 'prime_awards' END, CASE WHEN scope_wins >= 5 THEN 'scope' END, CASE WHEN most >= 2 THEN 'same_agency' END, CASE WHEN n_buyers >= 50 THEN 'many_buyers' END, CASE WHEN last_seen >= TIMESTAMP '2001-01-01' THEN 'recent' END, CASE WHEN typical_amount >= 30000 THEN 'comparable_value' END) AS evidence,
  concat_ws(',', CASE WHEN NOT economy THEN 'ECONOMY' END, CASE WHEN NOT promo THEN 'PROMO' END) AS capability_gap FROM known),
primes AS (SELECT vendor, evidence, CAST(n_evidence AS BIGINT) AS n_evidence, capability_gap FROM told WHERE n_evidence >= 4 AND vendor NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0))"""


def _primes(spark, sf_dir, b=None):
    """Four of six kinds of evidence, from b or all bids."""
    c = F.col
    b = stored(awarded(spark, sf_dir).select("vendor", "buyer", "won", "amount", "date", "category"), "bids") if b is None else b
    met = bidding.vendor_profiles(b).join(bidding.scope_evidence(b, SCOPE), "vendor", "left")
    rules = {"prime_awards": c("n_wins") >= 10, "scope": c("scope_wins") >= 5, "same_agency": c("most_wins_with_one_buyer") >= 2, "many_buyers": c("n_buyers") >= 50, "recent": c("last_seen") >= F.lit("2001-01-01").cast("timestamp"), "comparable_value": c("typical_amount") >= 30000}
    barred = table(spark, sf_dir, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("vendor"))
    return bidding.prime_candidates(met, rules, 4, barred)


@query(f"WITH {BIDS}, {PRIMES} SELECT * FROM primes")
def s30_prime_candidates(spark, sf_dir):
    return _primes(spark, sf_dir)


@query(f"WITH {LIKELY}, {PRIMES} SELECT vendor FROM likely INTERSECT SELECT vendor FROM primes")
def s46_teaming_overlap(spark, sf_dir):
    b = stored(awarded(spark, sf_dir).select("event", "vendor", "buyer", "won", "amount", "date", "category"), "bids")
    return bidding.likely_bidders(b, CUTOFF).select("vendor").intersect(_primes(spark, sf_dir, b).select("vendor"))


def _model_bids(spark, sf_dir):
    return Scratch(spark, "bids", kept=False).save(awarded(spark, sf_dir).select("event", "vendor", "buyer", "category", "amount", "date", "won"), "bids")


def _predicted(b):
    """The best five candidates of each held-out event of the bids b."""
    scratch, steps = (Scratch(b.sparkSession, name, kept=False) for name in ("pairs", "known"))
    old = b.where(F.col("date") < F.lit(CUTOFF).cast("timestamp"))
    pairs = scratch.save(prediction.candidate_features(prediction.training_pairs(old), old, steps).select("event", "label", *prediction.FEATURES), "pairs")
    steps.clear()
    model = prediction.fit(pairs)
    scratch.drop(pairs)
    held = prediction.events_of(b.where(F.col("date") >= F.lit(CUTOFF).cast("timestamp")))
    return prediction.predicted_bidders(model, held, b, CUTOFF)


def s26_predicted_bidders(spark, sf_dir):
    """The best five candidates of each held-out order by a calibrated model of ten features, learned before the cutoff.  SQL has no such fit: tests hold it against closed cases."""
    return _predicted(_model_bids(spark, sf_dir))


QUERIES["s26_predicted_bidders"] = s26_predicted_bidders


def s34_precision_of_model(spark, sf_dir):
    """Precision and coverage of s26_predicted_bidders over all held-out events, beside those of the fixed weights (s34_precision_at_k)."""
    b = _model_bids(spark, sf_dir)
    held = b.where(F.col("date") >= F.lit(CUTOFF).cast("timestamp"))
    scratch = Scratch(spark, "told", kept=False)
    ways = {"model": lambda: _predicted(b), "fixed_weights": lambda: bidding.likely_bidders(b, CUTOFF)}
    told = []
    for way, predicted in ways.items():
        best = scratch.save(predicted().select("event", "vendor", "place"), "predicted")
        told.append(scratch.save(bidding.precision_at(best, b, held=held).withColumn("way", F.lit(way)), "told"))
        scratch.drop(best)
    return told[0].unionByName(told[1])


QUERIES["s34_precision_of_model"] = s34_precision_of_model


@query(f"""WITH {LIKELY}, a AS (SELECT DISTINCT event, vendor FROM bids WHERE date >= TIMESTAMP '{CUTOFF}'), hit AS (SELECT a.event, likely.place FROM a LEFT JOIN likely ON likely.event = a.event AND likely.vendor = a.vendor)
SELECT count(DISTINCT event) AS n_events, round(count(*) FILTER (WHERE place <= 3) / (count(DISTINCT event) * 3), 6) AS precision_at_3, round(count(*) FILTER (WHERE place <= 5) / (count(DISTINCT event) * 5), 6) AS precision_at_5, round(count(place) / count(*), 6) AS coverage FROM hit""")
def s34_precision_at_k(spark, sf_dir):
    """Over all held-out events; those without predictions are misses."""
    b = stored(awarded(spark, sf_dir).select("event", "vendor", "buyer", "won", "date"), "bids")
    return bidding.precision_at(stored(bidding.likely_bidders(b, CUTOFF), "likely"), b, held=b.where(F.col("date") >= F.lit(CUTOFF).cast("timestamp")))


@query(f"SELECT CASE WHEN o_orderdate < TIMESTAMP '{CUTOFF}' THEN 'train' ELSE 'held_out' END AS part, count(*) AS n, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date FROM orders GROUP BY 1")
def s35_holdout_split(spark, sf_dir):
    part = F.when(F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp"), "train").otherwise("held_out")
    return table(spark, sf_dir, "orders").groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"))


@query(f"""WITH {BIDS}, s AS (SELECT vendor, list_distinct(list(category)) AS types FROM bids WHERE won GROUP BY 1)
SELECT vendor, len(list_intersect(types, ['ECONOMY', 'PROMO', 'STANDARD'])) AS n_met, len(list_intersect(types, ['ECONOMY', 'PROMO', 'STANDARD'])) = 3 AS compatible, least(CAST(len(list_intersect(types, ['ECONOMY', 'PROMO', 'STANDARD'])) AS BIGINT), 2) AS weight FROM s""")
def s53_certification(spark, sf_dir):
    """A vendor holds what it has won awards in."""
    return assemble.certification(awarded(spark, sf_dir).where("won").select("vendor", F.col("category").alias("held")), ["ECONOMY", "PROMO", "STANDARD"], 2)


# ---- assembly ----


@query("""WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 AS side FROM events),
p AS (SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS portal_value, max(ts) AS portal_ts FROM e WHERE side = 0 GROUP BY 1, 2),
d AS (SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS document_value, max(ts) AS document_ts FROM e WHERE side = 1 GROUP BY 1, 2)
SELECT user_id, event_type, portal_value, document_value, portal_value <> document_value AS conflict, CASE WHEN document_ts IS NULL OR portal_ts > document_ts THEN portal_value ELSE document_value END AS controlling
FROM p FULL JOIN d USING (user_id, event_type)""")
def s15_conflicts(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("side", F.get_json_object("props", "$.k").cast("long") % 2)
    return assemble.conflicts(e.where("side = 0"), e.where("side = 1"), ["user_id", "event_type"], "value", ["ts", "event_id"])


@query("""SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value, max(ts) AS ts, count(*) AS n_versions FROM events GROUP BY 1, 2""")
def s40_upsert_latest(spark, sf_dir):
    return assemble.latest(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"], ["event_id", "value", "ts"])


@query("""SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value, max(ts) AS ts FROM events GROUP BY 1, 2""")
def s40_incremental_import(spark, sf_dir):
    """Events imported in three overlapping batches, the second of them twice."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts")
    path, k = Scratch(spark, "import").path("table"), F.col("event_id") % 10
    for batch in (e.where(k < 6), e.where(k.between(4, 8)), e.where(k.between(4, 8)), e.where(k > 7)):
        merge.merge(spark, path, batch, ["user_id", "event_type"], ["ts", "event_id"], 8)
    return spark.read.parquet(path).select(*e.columns)


@query(f"""WITH {RAW} SELECT CAST(doc_id AS VARCHAR) AS id, 'unreviewed' AS reason FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'low_quality' FROM labels WHERE quality = 0
UNION ALL SELECT sha256(text), 'duplicate' FROM documents GROUP BY text HAVING count(*) > 1
UNION ALL (WITH e AS (SELECT c_name AS entity, ltrim(lower(replace(c_name, 'Customer#', ''))) AS name, c_nationkey AS place FROM customer UNION ALL SELECT s_name, ltrim(lower(replace(s_name, 'Supplier#', ''))), s_nationkey FROM supplier)
  SELECT entity, 'identity' FROM (SELECT entity, count(*) OVER (PARTITION BY name, place) AS a, count(*) OVER (PARTITION BY name) AS b FROM e) WHERE a = 1 AND b > 1)
UNION ALL (WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 AS side FROM events),
  p AS (SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS v FROM e WHERE side = 0 GROUP BY 1, 2), d AS (SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS v FROM e WHERE side = 1 GROUP BY 1, 2)
  SELECT user_id || '/' || event_type, 'conflict' FROM p JOIN d USING (user_id, event_type) WHERE p.v IS DISTINCT FROM d.v)
UNION ALL SELECT CAST(k AS VARCHAR), 'low_confidence' FROM raw WHERE error IS NULL AND k % 2 = 1""")
def s32_review_queue(spark, sf_dir):
    """What people should look at: identities, conflicts and low confidence besides documents."""
    d, lab = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    feeds = {"unreviewed": d.join(lab, "doc_id", "left_anti").select(F.col("doc_id").cast("string").alias("id")), "low_quality": lab.where("quality = 0").select(F.col("doc_id").cast("string").alias("id")), "duplicate": dedupe.exact_duplicates(d, F.sha2("text", 256), "doc_id", "source").select(F.col("content_hash").alias("id"))}
    feeds["identity"] = s23_vendor_resolution(spark, sf_dir).where("verdict = 'review'").select(F.col("entity").alias("id"))
    feeds["conflict"] = s15_conflicts(spark, sf_dir).where("conflict").select(F.concat(F.col("user_id").cast("string"), F.lit("/"), "event_type").alias("id"))
    feeds["low_confidence"] = normalize.opportunities(_raw(spark, sf_dir)).where("confidence < 1").select(F.col("file").alias("id"))
    return assemble.review_feed(feeds)


@query(r"SELECT n_nationkey, regexp_replace(substr(sha256(length('nation') || ':nation' || length(CAST(n_nationkey AS VARCHAR)) || ':' || n_nationkey), 1, 32), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5') AS local_id FROM nation")
def s39_local_uuids(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", expr.local_uuid(F.lit("nation"), F.col("n_nationkey")).alias("local_id"))


@query("""SELECT c_custkey, count(o_orderkey) AS n_orders, CAST(sum(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS pending_value FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def s41_unknown_not_zero(spark, sf_dir):
    """A buyer without pending orders has no pending value, not one of 0."""
    met = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left")
    return met.groupBy("c_custkey").agg(F.count("o_orderkey").alias("n_orders"), F.sum(F.when(F.col("o_orderstatus") == "P", bidding.money("o_totalprice"))).cast("double").alias("pending_value"))


@query("SELECT event_id, ts AS generated_at, ts + INTERVAL 30 DAYS AS expires_at, ts + INTERVAL 30 DAYS > TIMESTAMP '2024-02-15' AS valid FROM events")
def s45_snapshots(spark, sf_dir):
    return assemble.snapshots(table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("generated_at")), 30, "2024-02-15")


@query(f"""WITH {BIDS}, w AS (SELECT s_nationkey AS place, vendor, count(*) FILTER (WHERE won) AS wins FROM bids JOIN supplier ON s_suppkey = vendor GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY wins DESC, vendor) AS k FROM w)
SELECT place, '[' || string_agg('{{"rank":' || k || ',"vendor":' || vendor || ',"wins":' || wins || '}}', ',' ORDER BY k) || ']' AS payload FROM r WHERE k <= 3 GROUP BY place""")
def s51_partner_payload(spark, sf_dir):
    met = awarded(spark, sf_dir).join(table(spark, sf_dir, "supplier"), F.col("vendor") == F.col("s_suppkey"))
    return assemble.partner_payload(met.groupBy(F.col("s_nationkey").alias("place"), "vendor").agg(F.count_if("won").alias("wins")), 3)


def import_exports(spark, sf_dir):
    """What an analysis hands over, in the order of import."""
    return exports.exports(spark, sf_dir, awarded(spark, sf_dir), s51_partner_payload(spark, sf_dir))


_UUID = lambda *parts: "regexp_replace(substr(sha256(" + " || ".join(f"length(CAST({p} AS VARCHAR)) || ':' || {p}" for p in parts) + r"), 1, 32), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5')"


@query(f"""WITH {BIDS} SELECT 'sources' AS export, count(DISTINCT source) AS n, min({_UUID("'source'", "source")}) AS first_id FROM documents
UNION ALL SELECT 'records', count(*), min({_UUID("'record'", "o_orderkey")}) FROM orders UNION ALL SELECT 'competitors', count(*), min({_UUID("'competitor'", "s_suppkey")}) FROM supplier
UNION ALL SELECT 'documents', count(*), min({_UUID("'document'", "doc_id")}) FROM documents UNION ALL SELECT 'participants', count(*), min({_UUID("'participant'", "event", "line", "vendor", "commodity", "copy")}) FROM (SELECT *, row_number() OVER (PARTITION BY event, line, vendor, commodity ORDER BY amount) AS copy FROM bids)
UNION ALL SELECT 'document_content_handoff', sum(len(string_split(text, chr(10)))), min({_UUID("'document'", "doc_id")}) FROM documents
UNION ALL SELECT 'partner_match_payloads', count(DISTINCT s_nationkey), min({_UUID("'payload'", "s_nationkey")}) FROM bids JOIN supplier ON s_suppkey = vendor""")
def s50_import_exports(spark, sf_dir):
    """How many rows each export has, and the first of their ids."""
    found = [df.agg(F.lit(name).alias("export"), F.count(F.lit(1)).alias("n"), F.min(df.columns[0]).alias("first_id")) for name, df in import_exports(spark, sf_dir).items()]
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


@query("SELECT window_start, event_type, n, total FROM (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2)")
def x_daily_observations(spark, sf_dir):
    from tenderlake.streaming.observations import daily

    return daily(table(spark, sf_dir, "events"))
