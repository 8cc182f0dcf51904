"""More queries with their SQL: the library's whole steps, on rows made of the supplied tables in the sources' shapes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import candidates as C
from ..operators import canonical, checks, ingest, resolve, review, state
from ..operators.transforms import TRANSFORMS
from ..sources import delimited, workbook
from . import views
from .demo import _query, _seeded, _t

_JOINED = "array_to_string(list_filter([{}], lambda x: x IS NOT NULL), ',')"

# --- rows of the five sources to records with problems -------------------------------------------------------------------


def _scimago_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as rows of the wide file; the file's name tells year and subject area."""
    key, size = F.col("p_partkey"), F.col("p_size")
    return _t(spark, sf_dir, "part").select(
        F.concat(F.lit("file:/raw/scimagojr "), 1990 + size % 30, F.lit("%20%20Subject%20Area%20-%20"), F.replace("p_type", F.lit(" "), F.lit("%20")), F.lit(".csv")).alias("_file"), key.cast("long").alias("_row_number"),
        F.when(key % 50 != 0, F.col("p_brand")).otherwise(" ").alias("Sourceid"), F.when(key % 70 != 0, F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("Title"),
        F.when(size % 10 == 0, "100,5").otherwise(F.concat(size, F.lit(","), F.lpad((key % 1000).cast("string"), 3, "0"))).alias("SJR"), F.concat(F.lit("q"), size % 6).alias("SJR Best Quartile"),
        F.when(key % 3 == 0, "Yes").when(key % 3 == 1, "No").alias("Open Access"), size.cast("string").alias("H index"), key.cast("string").alias("Total Docs. (1995)"), F.lit("7").alias("Total Docs. (1996)"),
        F.concat("p_brand", F.lit(" (Q2); "), "p_type").alias("Categories"), F.concat("p_type", F.lit("; ;"), "p_name").alias("Areas"),
    )


@_query(
    "SELECT p_partkey AS row_number, (1990 + p_size % 30)::INT AS year, p_type AS subject_area, CASE WHEN p_partkey % 70 <> 0 THEN p_name END AS title, "
    "CASE WHEN p_size % 10 = 0 THEN 100.5 ELSE p_size + (p_partkey % 1000) / 1000.0 END::DECIMAL(10,3) AS sjr, CASE WHEN p_size % 6 BETWEEN 1 AND 4 THEN 'Q' || (p_size % 6) END AS quartile, p_size::INT AS h_index, "
    "CASE 1990 + p_size % 30 WHEN 1995 THEN p_partkey WHEN 1996 THEN 7 END::INT AS total_docs, p_partkey % 3 = 0 AS open_access, 2 AS categories, 2 AS areas, "
    "CASE WHEN p_size % 10 = 0 THEN 'sjr_out_of_range' ELSE " + _JOINED.format("CASE WHEN p_partkey % 50 = 0 THEN 'sourceid_missing' END, CASE WHEN p_partkey % 70 = 0 THEN 'title_missing' END") + " END AS problems FROM part"
)
def scimago_records(spark, sf_dir):
    made = TRANSFORMS["SCIMAGO"](_scimago_rows(spark, sf_dir))
    return made.select(F.col("_row_number").alias("row_number"), "year", "subject_area", "title", "sjr", F.col("sjr_best_quartile").alias("quartile"), "h_index", "total_docs", "open_access", F.size("categories").alias("categories"), F.size("areas").alias("areas"), F.array_join("problems", ",").alias("problems"))


def _abdc_sql() -> str:
    rating = "CASE c_nationkey % 5 WHEN 0 THEN 'A*' WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 3 THEN 'C' END"
    return " UNION ALL ".join(
        f"SELECT c_custkey AS row_number, {year}::INT AS rating_year, '{scheme}' AS for_scheme, CASE WHEN c_custkey % 40 <> 0 THEN c_name END AS journal_name, CASE WHEN c_custkey % 2 = 0 THEN lpad(c_custkey::VARCHAR, 7, '0') || 'X' END AS issn, {rating} AS rating, CASE WHEN c_custkey % 40 = 0 THEN 'journal_name_missing' ELSE '' END AS problems FROM customer"
        for year, scheme, _ in workbook.SHEETS.values()
    )


@_query(_abdc_sql())
def abdc_records(spark, sf_dir):
    out, key = None, F.col("c_custkey")
    for sheet, (_, _, rating) in workbook.SHEETS.items():
        rows = _t(spark, sf_dir, "customer").select(
            F.lit("list.xlsx").alias("_file"), key.cast("long").alias("_row_number"), F.when(key % 40 != 0, F.col("c_name")).otherwise(" ").alias("Journal Title"), F.when(key % 2 == 0, F.concat(F.lpad(key.cast("string"), 7, "0"), F.lit("x"))).otherwise("none").alias("ISSN"),
            F.element_at(F.array(*map(F.lit, ("a*", " A", "b ", "C", "?"))), (F.col("c_nationkey") % 5 + 1).cast("int")).alias(rating.upper()),
        )
        made = TRANSFORMS["ABDC"](rows, sheet).select(F.col("_row_number").alias("row_number"), "rating_year", "for_scheme", "journal_name", "issn", "rating", F.array_join("problems", ",").alias("problems"))
        out = made if out is None else out.unionByName(made)
    return out


def _abs_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return _t(spark, sf_dir, "orders").select(F.lit("guide.csv").alias("_file"), key.cast("long").alias("_row_number"), F.when(key % 11 != 0, F.concat(F.lit("T"), key)).alias("TITLE"), F.lit("F").alias("FIELD"), F.col("o_orderpriority").alias("AJG2018"), F.element_at(F.array(*map(F.lit, ("1", "2 ", "3", " 4*", "4", "5", " "))), (key % 7 + 1).cast("int")).alias("AJG2021"))


@_query(
    "SELECT o_orderkey AS row_number, rating_year, rating, " + _JOINED.format("CASE WHEN o_orderkey % 11 = 0 THEN 'journal_name_missing' END, CASE WHEN rating NOT IN ('1', '2', '3', '4', '4*') THEN 'invalid_rating' END") + " AS problems FROM ("
    "SELECT o_orderkey, 2018 AS rating_year, o_orderpriority AS rating FROM orders UNION ALL SELECT o_orderkey, 2021, CASE o_orderkey % 7 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN '4*' WHEN 4 THEN '4' WHEN 5 THEN '5' END FROM orders) WHERE rating IS NOT NULL"
)
def abs_records(spark, sf_dir):
    return TRANSFORMS["ABS"](_abs_rows(spark, sf_dir)).select(F.col("_row_number").alias("row_number"), "rating_year", "rating", F.array_join("problems", ",").alias("problems"))


@_query(
    "SELECT s_suppkey AS row_number, CASE WHEN s_suppkey % 13 <> 0 THEN s_suppkey % 17 END::INT AS rank, s_name AS journal_name, CASE WHEN s_suppkey % 2 = 0 THEN 'House ' || s_nationkey END AS publisher, CASE WHEN s_suppkey % 2 = 0 THEN 'high' ELSE 'none' END AS confidence, "
    "CASE WHEN s_suppkey % 7 <> 0 THEN s_nationkey + 0.25 END::DECIMAL(10,3) AS score, " + _JOINED.format("CASE WHEN s_suppkey % 13 <> 0 AND s_suppkey % 17 = 0 THEN 'invalid_rank' END, CASE WHEN s_suppkey % 7 = 0 THEN 'invalid_number' END") + " AS problems FROM supplier"
)
def repec_records(spark, sf_dir):
    key = F.col("s_suppkey")
    rows = _t(spark, sf_dir, "supplier").select(
        F.lit("rank.csv").alias("_file"), key.cast("long").alias("_row_number"), F.when(key % 13 == 0, "x").otherwise((key % 17).cast("string")).alias("rank"), F.concat(F.lit(" "), "s_name", F.when(key % 2 == 0, F.concat(F.lit(", House "), "s_nationkey")).otherwise("")).alias("journals"),
        F.when(key % 7 == 0, "n/k").otherwise(F.concat("s_nationkey", F.lit(",25"))).alias("score"),
    )
    made = TRANSFORMS["REPEC"](rows)
    return made.select(F.col("_row_number").alias("row_number"), "rank", F.col("journal_name_clean").alias("journal_name"), F.col("publisher_from_name").alias("publisher"), F.col("publisher_split_confidence").alias("confidence"), "score", F.array_join("problems", ",").alias("problems"))


@_query(
    "SELECT c_custkey AS row_number, CASE WHEN c_custkey % 9 <> 0 THEN 2026 END::INT AS ft50_year, c_nationkey::INT AS rank, CASE WHEN c_custkey % 8 <> 0 THEN c_name END AS journal_name, "
    + _JOINED.format("CASE WHEN c_custkey % 8 = 0 THEN 'journal_name_missing' END, CASE WHEN c_custkey % 9 = 0 THEN 'invalid_ft50_year' END, CASE WHEN c_nationkey < 1 THEN 'invalid_rank' END") + " AS problems FROM customer"
)
def ft50_records(spark, sf_dir):
    key = F.col("c_custkey")
    rows = _t(spark, sf_dir, "customer").select(F.lit("ft.csv").alias("_file"), key.cast("long").alias("_row_number"), F.col("c_nationkey").cast("string").alias("rank"), F.when(key % 8 != 0, F.col("c_name")).otherwise("").alias("journal_name"), F.when(key % 9 == 0, "n/k").otherwise("2026.0").alias("ft50_year"))
    return TRANSFORMS["FT50"](rows).select(F.col("_row_number").alias("row_number"), "ft50_year", "rank", "journal_name", F.array_join("problems", ",").alias("problems"))


@_query(
    "WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS n, l_partkey AS h, l_linenumber AS y, l_quantity > 45 AS a, l_discount > 0.08 AS b FROM lineitem), g AS (SELECT n, row_number() OVER (PARTITION BY h, y ORDER BY n) AS k FROM r WHERE NOT a AND NOT b) "
    "SELECT 'valid' AS kind, n AS row_number, NULL AS reason FROM g WHERE k = 1 UNION ALL SELECT 'repeat', n, NULL FROM g WHERE k > 1 UNION ALL SELECT 'rejected', n, 'quantity' FROM r WHERE a UNION ALL SELECT 'rejected', n, 'discount' FROM r WHERE b"
)
def split_records(spark, sf_dir):
    """Lines as records of a source: the first of each key, one rejection a problem, and the rows that repeat a key."""
    found = F.array_compact(F.array(F.when(F.col("l_quantity") > 45, F.lit("quantity")), F.when(F.col("l_discount") > 0.08, F.lit("discount"))))
    rows = _t(spark, sf_dir, "lineitem").select(F.lit("f").alias("_file"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("_row_number"), F.col("l_partkey").cast("string").alias("source_row_hash"), F.col("l_linenumber").alias("ft50_year"), F.lit("{}").alias("raw_json"), found.alias("problems"))
    valid, rejected, repeats = ingest.split_records(rows, "FT50")
    none = F.lit(None).cast("string").alias("reason")
    return valid.select(F.lit("valid").alias("kind"), F.col("_row_number").alias("row_number"), none).unionByName(repeats.select(F.lit("repeat").alias("kind"), F.col("_row_number").alias("row_number"), none)).unionByName(rejected.select(F.lit("rejected").alias("kind"), "row_number", "reason"))


# --- a file through the import -------------------------------------------------------------------------------------------


def _folder(spark: SparkSession) -> str:
    """A new folder in the one that all executors share."""
    state.durable(spark.range(0))  # sets one where none is
    return f"{spark.sparkContext.getCheckpointDir()}/demo-{uuid.uuid4().hex}"


def _csv_files(df: DataFrame, folder: str, by: str, order: str, sep: str = ",") -> None:
    """df as a file for each value of a column, named by it, as a source would send them; the files are written in parallel."""
    spark = df.sparkSession
    df.repartition(by).sortWithinPartitions(by, order).write.partitionBy(by).csv(f"{folder}.parts", header=True, sep=sep, escape='"')
    make = spark._jvm.org.apache.hadoop.fs.Path
    fs = make(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(make(folder))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(f"{folder}.parts").select("path")
    for r in files.withColumn("name", F.url_decode(F.regexp_extract("path", f"/{by}=([^/]*)/", 1))).collect():  # one name a file
        fs.rename(make(r.path), make(f"{folder}/{r.name}.csv"))
    fs.delete(make(f"{folder}.parts"), True)


@_query(
    "WITH s AS (SELECT c_custkey, n_nationkey, n_name, c_custkey % 10 = 0 AS bad, dense_rank() OVER (ORDER BY n_name) AS d, row_number() OVER (ORDER BY n_name, c_custkey) AS n, row_number() OVER (PARTITION BY n_name ORDER BY c_custkey) AS k FROM customer JOIN nation ON n_nationkey = c_nationkey), g AS (SELECT *, row_number() OVER (ORDER BY n) AS id FROM s WHERE NOT bad) "
    "SELECT 'raw' AS kind, n AS id, d::BIGINT AS dataset, 'S;' || c_custkey AS a, k::VARCHAR AS b FROM s UNION ALL SELECT 'rejection', k, d, 'title_missing', NULL FROM s WHERE bad "
    "UNION ALL SELECT 'record', id, d, 'S;' || c_custkey, '2019 ' || n_name || ' \"Letters\"' FROM g UNION ALL SELECT 'category', id, NULL, 'Law', 'Q1' FROM g UNION ALL SELECT 'category', id, NULL, 'Ethics', NULL FROM g UNION ALL SELECT 'area', id, NULL, 'Arts', NULL FROM g "
    "UNION ALL SELECT 'dataset', count(*) FILTER (WHERE NOT bad), d, 'loaded', 'loaded skipped' FROM s GROUP BY d UNION ALL SELECT 'dataset', NULL, max(d) + 1, 'failed', 'failed failed' FROM s"
)
def ingest_file(spark, sf_dir):
    """Customers written as a delimited file a nation and one that breaks the rules, all found and loaded together, twice, and what the tables then hold."""
    folder, key = _folder(spark), F.col("c_custkey")
    nations = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.concat(F.lit("scimagojr 2019  Subject Area - "), "n_name", F.lit(' "Letters"')).alias("file"))
    row = [F.concat(F.lit("S;"), key).alias("Sourceid"), F.when(key % 10 != 0, F.concat(F.lit('A "title", '), key)).alias("Title"), F.lit("1,5").alias("SJR"), F.lit("Q1").alias("SJR Best Quartile"), F.lit("Law (Q1); Ethics").alias("Categories"), F.lit("Arts").alias("Areas")]
    rows = _t(spark, sf_dir, "customer").join(nations, "c_nationkey").select("file", key, *row)
    broken = nations.groupBy().agg(F.lit("scimagojr 2019  Subject Area - ~broken").alias("file"), F.count("*").alias("c_custkey")).select("file", key, *row).withColumn("Title", F.repeat(F.lit("x"), 501))
    _csv_files(rows.unionByName(broken), f"{folder}/raw", "file", "c_custkey", ";")
    paths, store = delimited.discover(spark, f"{folder}/raw"), state.Store(spark, f"{folder}/store")
    once, twice = (ingest.import_files(store, "SCIMAGO", paths) for _ in range(2))
    said = spark.createDataFrame([(p.rsplit("/", 1)[-1], " ".join(x[p].split(":")[0] for x in (once, twice))) for p in once], "file_name string, said string")
    none, r = F.lit(None).cast("string"), store.read
    files = r("raw_files").select(F.col("id").alias("raw_file_id"), "dataset_id")
    parts = [
        r("raw_rows").join(files, "raw_file_id").select(F.lit("raw"), "id", "dataset_id", F.get_json_object("raw_data", "$.Sourceid"), F.col("row_number").cast("string")),
        r("ingestion_rejections").select(F.lit("rejection"), "row_number", "dataset_id", "reason", none),
        r("scimago_records").select(F.lit("record"), "id", "dataset_id", "sourceid", F.concat_ws(" ", "year", "subject_area")),
        r("scimago_categories").select(F.lit("category"), "scimago_record_id", F.lit(None).cast("long"), "category_name", "quartile"),
        r("scimago_areas").select(F.lit("area"), "scimago_record_id", F.lit(None).cast("long"), "area_name", none),
        r("datasets").join(said, "file_name").select(F.lit("dataset"), "record_count", "id", "status", "said"),
    ]
    out = None
    for part in parts:
        part = part.toDF("kind", "id", "dataset", "a", "b")
        out = part if out is None else out.unionByName(part)
    return out


@_query(
    "SELECT 'orders ' || o_orderpriority || '.csv' AS file_name, 'utf-8' AS encoding, '|' AS delimiter, count(*)::BIGINT AS row_count, '[\"key\", \"ISSN\", \"note\"]' AS columns, 'has_identifier' AS identifier_status FROM orders GROUP BY o_orderpriority "
    "UNION ALL SELECT 'nations ' || n_regionkey || '.csv', 'utf-8', ',', count(*), '[\"n_nationkey\", \"n_name\"]', 'title_only' FROM nation GROUP BY n_regionkey"
)
def inventory_profile(spark, sf_dir):
    """Two tables written as several files of different delimiters, some with line breaks in quotes, and the inventory of all."""
    from ..sources import inventory

    folder = _folder(spark)
    note = F.when(F.col("o_orderpriority").startswith("1"), F.concat("o_orderstatus", F.lit("\n"), "o_orderkey")).otherwise(F.col("o_orderstatus"))
    _csv_files(_t(spark, sf_dir, "orders").select(F.concat(F.lit("orders "), "o_orderpriority").alias("file"), F.col("o_orderkey").alias("key"), F.lit("0378-5955").alias("ISSN"), note.alias("note")), f"{folder}/orders", "file", "key", "|")
    _csv_files(_t(spark, sf_dir, "nation").select(F.concat(F.lit("nations "), "n_regionkey").alias("file"), "n_nationkey", "n_name"), f"{folder}/nations", "file", "n_nationkey")
    files = [(source, path) for source, name in (("ABS", "orders"), ("FT50", "nations")) for path in delimited.discover(spark, f"{folder}/{name}")]
    return inventory.inventory(spark, files).select("file_name", "encoding", "delimiter", "row_count", "columns", "identifier_status")


# --- keys, lineage, the canonical dimension ------------------------------------------------------------------------------


@_query(
    "WITH e AS (SELECT l_partkey AS r, l_suppkey AS j, max(l_quantity) AS q, min(l_linenumber) AS k, bool_or(l_returnflag = 'R') AS f FROM lineitem GROUP BY ALL), v AS (SELECT *, (q / 50)::DECIMAL(5,4) AS s, round((q + 1) / 60, 4)::DECIMAL(5,4) AS t, CASE WHEN r % 5 = 0 THEN 'exact_title_ambiguous' ELSE 'fuzzy_title' END AS m FROM e) "
    "SELECT r AS source_record_id, j AS candidate_journal_id, CASE WHEN r % 2 = 1 THEN t WHEN r % 3 = 0 THEN s ELSE greatest(s, t) END AS similarity, CASE WHEN r % 2 = 0 AND r % 3 = 0 THEN false ELSE f END AS issn_match, CASE WHEN r % 2 = 1 THEN m WHEN r % 3 = 0 OR r % 5 <> 0 THEN 'fuzzy_title' ELSE 'fuzzy_title+exact_title_ambiguous' END AS match_method, "
    "CASE WHEN r % 2 = 1 THEN k WHEN r % 3 = 0 THEN 3 ELSE least(3, k) END::SMALLINT AS rank_among_candidates, CASE WHEN r % 2 = 0 AND r % 3 = 0 THEN 'accepted' ELSE 'pending' END AS review_status, r % 2 = 1 AS is_new FROM v"
)
def candidate_upsert(spark, sf_dir):
    """Evidence on a part's suppliers merged into a queue that has the even parts, some of them reviewed."""
    lines = _t(spark, sf_dir, "lineitem").select(F.lit(2).alias("source_id"), F.lit("part").alias("source_record_table"), F.col("l_partkey").alias("source_record_id"), F.col("l_suppkey").alias("candidate_journal_id"), "l_quantity", "l_linenumber", "l_returnflag")
    record = F.col("source_record_id")
    old = lines.where(record % 2 == 0).groupBy(*C.KEY).agg(F.max(F.round(F.col("l_quantity") / 50, 4)).alias("similarity")).withColumns({"id": record * 100_000 + F.col("candidate_journal_id"), "match_method": F.lit("fuzzy_title"), "issn_match": F.lit(False), "rank_among_candidates": F.lit(3), "review_status": F.when(record % 3 == 0, "accepted").otherwise("pending")})
    new = lines.select(*C.KEY, F.round((F.col("l_quantity") + 1) / 60, 4).cast("decimal(5,4)").alias("similarity"), (F.col("l_returnflag") == "R").alias("issn_match"), F.lit(False).alias("publisher_match"), F.when(record % 5 == 0, "exact_title_ambiguous").otherwise("fuzzy_title").alias("match_method"), F.col("l_linenumber").cast("short").alias("rank_among_candidates"), F.lit(1).alias("seq"))
    merged = C.upsert(schemas.conform(old, "entity_match_candidates"), C.fold(new))
    return merged.select("source_record_id", "candidate_journal_id", "similarity", "issn_match", "match_method", "rank_among_candidates", "review_status", F.col("id").isNull().alias("is_new"))


@_query(
    "WITH claims AS (SELECT DISTINCT p_brand, lpad((p_partkey % 600)::VARCHAR, 4, '0') || '0000' AS v FROM part), ranked AS (SELECT *, row_number() OVER (PARTITION BY v ORDER BY p_brand) AS n, first(p_brand) OVER (PARTITION BY v ORDER BY p_brand) AS owner FROM claims) SELECT p_brand, v, owner, n = 1 AS owns FROM ranked"
)
def identifier_owners(spark, sf_dir):
    records = _t(spark, sf_dir, "part").select(F.col("p_brand").alias("sourceid"), (F.col("p_size") + 1990).alias("year"), F.col("p_type").alias("subject_area"), F.col("p_partkey").alias("id"), F.concat(F.lit("bad, "), F.lpad((F.col("p_partkey") % 600).cast("string"), 4, "0"), F.lit("-0000")).alias("issn_raw"))
    owned, conflicts = canonical.issn_owners(records)
    mine = owned.select(F.col("sourceid").alias("p_brand"), F.col("normalized_value").alias("v"), F.col("sourceid").alias("owner"), F.lit(True).alias("owns"))
    return mine.unionByName(conflicts.select(F.col("sourceid").alias("p_brand"), F.col("normalized_value").alias("v"), "owner", F.lit(False).alias("owns")))


@_query(
    "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN a ELSE a || ',' || b END AS issns FROM (SELECT p_partkey, p_size, lpad(p_partkey::VARCHAR, 7, '0') || 'X' AS a, lpad((p_partkey + 1)::VARCHAR, 8, '0') AS b FROM part)"
)
def ordered_distinct(spark, sf_dir):
    """A record's valid identifiers in the order of its columns, each once."""
    a, b = F.concat(F.lpad(F.col("p_partkey").cast("string"), 7, "0"), F.lit("x")), F.lpad((F.col("p_partkey") + 1).cast("string"), 8, "0")
    rows = _t(spark, sf_dir, "part").select("p_partkey", a.alias("first"), F.lit("none").alias("second"), F.when(F.col("p_size") % 3 == 0, a).otherwise(b).alias("third"))
    return rows.select("p_partkey", F.array_join(resolve.S.distinct_issns("first", "second", "third"), ",").alias("issns"))


@_query(
    "WITH d AS (SELECT doc_id, doc_id % 5 + 1 AS s, n_chars < 100 AS bad, doc_id % 50 = 4 AS none FROM documents) SELECT CASE s WHEN 1 THEN 'SCIMAGO' WHEN 2 THEN 'ABDC' WHEN 3 THEN 'ABS' WHEN 4 THEN 'REPEC' ELSE 'FT50' END AS source_code, count(*)::BIGINT AS raw_rows, "
    "(count(*) FILTER (WHERE NOT bad AND NOT none) * CASE WHEN s IN (3, 4) THEN 2 ELSE 1 END)::BIGINT AS normalized_records, count(*) FILTER (WHERE bad AND NOT none)::BIGINT AS ingestion_rejections, count(*) FILTER (WHERE none)::BIGINT AS skipped_rows, CASE WHEN s = 4 THEN 'FAIL' ELSE 'PASS' END AS status FROM d GROUP BY s"
)
def lineage_reconcile(spark, sf_dir):
    """Documents as raw rows of five datasets: short ones rejected, some skipped; one source has two records a row and may, another has and mustn't."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", (F.col("doc_id") % 5 + 1).alias("dataset_id"), (F.col("n_chars") < 100).alias("bad"), (F.col("doc_id") % 50 == 4).alias("none"), F.coalesce("text", F.lit("")).alias("raw_data"))
    datasets = spark.range(1, 6).select("id", F.col("id").cast("int").alias("source_id"), F.lit("loaded").alias("status"))
    files = datasets.select((F.col("id") * 10).alias("id"), F.col("id").alias("dataset_id"))
    raw = docs.select(F.col("doc_id").alias("id"), (F.col("dataset_id") * 10).alias("raw_file_id"), F.col("doc_id").alias("row_number"), "raw_data")
    rejected = docs.where("bad and not none").select("dataset_id", (F.col("dataset_id") * 10).alias("raw_file_id"), F.col("doc_id").alias("row_number")).withColumn("reason", F.explode(F.array(F.lit("a"), F.lit("b"))))
    good = docs.where("not bad and not none").withColumn("raw_row_id", F.col("doc_id"))
    twice = good.withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    records = {code: (twice if k in (3, 4) else good).where(F.col("dataset_id") == k) for code, k in schemas.SOURCE_IDS.items()}
    return checks.lineage(datasets, raw, files, rejected, records).select("source_code", "raw_rows", "normalized_records", "ingestion_rejections", "skipped_rows", "status")


@_query(
    "WITH j AS (SELECT CASE WHEN s_suppkey % 5 = 0 THEN s_suppkey - 1 ELSE s_suppkey END AS id, CASE WHEN s_suppkey % 7 <> 0 THEN s_name END AS title FROM supplier), "
    "i AS (SELECT l_orderkey, l_linenumber, l_partkey % 50 AS journal_id, CASE WHEN l_returnflag = 'R' THEN 'OTHER' ELSE 'ISSN' END AS t, (l_orderkey * 10 + l_linenumber) // 3 AS v, l_linestatus = 'O' AS p FROM lineitem) "
    "SELECT 'journals' AS name, 'unique(id)' AS constraint, '{\"id\":' || id || '}' AS detail, count(*)::BIGINT AS n FROM j GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'journals', 'required(canonical_title)', NULL, count(*) FROM j WHERE title IS NULL HAVING count(*) > 0 "
    "UNION ALL SELECT 'journal_identifiers', 'unique(identifier_type, normalized_value)', '{\"identifier_type\":\"' || t || '\",\"normalized_value\":\"' || v || '\"}', count(*) FROM i GROUP BY t, v HAVING count(*) > 1 "
    "UNION ALL SELECT 'journal_identifiers', 'domain(identifier_type)', t, count(*) FROM i WHERE t = 'OTHER' GROUP BY t UNION ALL SELECT 'journal_identifiers', 'one primary identifier a type', '{\"journal_id\":' || journal_id || ',\"identifier_type\":\"' || t || '\"}', count(*) FROM i WHERE p GROUP BY journal_id, t HAVING count(*) > 1 "
    "UNION ALL SELECT 'raw_files', 'length(file_path)', url, count(*) FROM (SELECT url || repeat('x', 501 - page_id % 2 - length(url)) AS url FROM pages WHERE length(url) < 400) WHERE length(url) > 500 GROUP BY url"
)
def constraint_violations(spark, sf_dir):
    """Suppliers, lines and pages as rows of three tables that break their rules of every kind."""
    key = F.col("s_suppkey")
    journals = _t(spark, sf_dir, "supplier").select(F.when(key % 5 == 0, key - 1).otherwise(key).alias("id"), F.when(key % 7 != 0, F.col("s_name")).alias("canonical_title"), F.lit("x").alias("normalized_title"))
    value = F.floor((F.col("l_orderkey") * 10 + F.col("l_linenumber")) / 3).cast("string")
    identifiers = _t(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 50).alias("journal_id"), F.when(F.col("l_returnflag") == "R", "OTHER").otherwise("ISSN").alias("identifier_type"), value.alias("normalized_value"), (F.col("l_linestatus") == "O").alias("is_primary"))
    url = F.concat("url", F.expr("repeat('x', cast(501 - page_id % 2 - length(url) as int))"))
    files = _t(spark, sf_dir, "pages").where("length(url) < 400").select(F.col("page_id").alias("id"), url.alias("file_path"))
    out = None
    for name, df in (("journals", journals), ("journal_identifiers", identifiers), ("raw_files", files)):
        part = schemas.violations(schemas.conform(df, name), name).select(F.lit(name).alias("name"), "constraint", "detail", "n")
        out = part if out is None else out.unionByName(part)
    return out


@_query(
    "SELECT unnest(['one identifier a source id', 'one journal a source id', 'records agree with identifiers', 'every record linked', 'a mapping and a decision a record', 'journals cover the source ids']) AS invariant, 0::BIGINT AS violations"
)
def seed_invariants(spark, sf_dir):
    made = _seeded(spark, sf_dir)
    return canonical.invariants(*(made[t] for t in ("scimago_records", "journals", "journal_identifiers", "journal_source_mapping", "entity_match_decisions")))


@_query(
    "WITH b AS (SELECT p_brand, count(*) AS n, row_number() OVER (ORDER BY p_brand) AS k FROM part GROUP BY 1), m AS (SELECT *, row_number() OVER (ORDER BY p_brand) AS j FROM b WHERE p_brand LIKE 'Brand#2%') "
    "SELECT b.p_brand AS sourceid, coalesce((SELECT max(k) FROM b) + m.j, b.k)::BIGINT AS journal_id, b.n::BIGINT AS records FROM b LEFT JOIN m USING (p_brand)"
)
def collision_repair(spark, sf_dir):
    """A seed whose source ids of some brands lost their own identifier: the repair gives their records journals of their own."""
    made = _seeded(spark, sf_dir)
    made.pop("conflicts")
    own = made["journal_identifiers"].where("not (identifier_type = 'SCIMAGO_SOURCE_ID' and normalized_value like 'Brand#2%')")
    changed = canonical.repaired_tables(state.Frames(spark, **(made | {"journal_identifiers": own})))
    return changed["scimago_records"].groupBy("sourceid").agg(F.min("journal_id").alias("journal_id"), F.count("*").alias("records"))


@_query(
    "SELECT c_custkey AS id, CASE WHEN n IS NULL THEN c_name ELSE 'renamed ' || n END AS canonical_title, CASE WHEN n IS NULL THEN 2020 ELSE 2026 END::INT AS updated FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey"
)
def journal_updates(spark, sf_dir):
    """Customers as journals, those with finished orders changed: whatever is hit is stamped."""
    journals = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("canonical_title"), F.lit("x").alias("normalized_title"), F.lit("2020-01-01").cast("timestamp").alias("updated_at"))
    changes = _t(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("id")).agg(F.concat(F.lit("renamed "), F.count("*")).alias("canonical_title"))
    changed = canonical.update_journals(schemas.conform(journals, "journals"), changes, F.lit("2026-01-01").cast("timestamp"))
    return changed.select("id", "canonical_title", F.year("updated_at").alias("updated"))


# --- resolution and review of a whole source -----------------------------------------------------------------------------


def _dimension(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Suppliers as journals, with titles that are like no other, and an identifier each."""
    suppliers = _t(spark, sf_dir, "supplier")
    title = F.md5(F.col("s_suppkey").cast("string"))
    journals = suppliers.select(F.col("s_suppkey").alias("id"), title.alias("canonical_title"), title.alias("normalized_title"))
    value = F.concat(F.lpad(F.col("s_suppkey").cast("string"), 7, "0"), F.lit("X"))
    return {"journals": journals, "journal_identifiers": suppliers.select(F.col("s_suppkey").alias("journal_id"), F.lit("ISSN").alias("identifier_type"), value.alias("identifier_value"), value.alias("normalized_value"))}


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as records of the quality list: by identifier, by title, with new titles that repeat, without any, and decided before."""
    key, nation = F.col("c_custkey") + 1, F.col("c_nationkey") % 8
    kind = key % 5
    name = F.when(kind == 0, F.md5((nation + 1).cast("string"))).when(kind == 1, F.md5(F.concat(F.lit("t"), key))).when(kind == 2, F.md5(F.concat(F.lit("new"), nation))).when(kind == 3, "...").otherwise(F.md5(F.concat(F.lit("old"), key)))
    issn = F.when(kind == 1, F.concat(F.lpad((nation + 1).cast("string"), 7, "0"), F.lit("X")))
    return _t(spark, sf_dir, "customer").select(key.alias("id"), name.alias("journal_name"), issn.alias("issn"), F.lit(2025).alias("rating_year"), F.sha2(key.cast("string"), 256).alias("source_row_hash"))


@_query(
    "WITH c AS (SELECT c_custkey + 1 AS id, c_nationkey % 8 AS n, (c_custkey + 1) % 5 AS kind FROM customer), made AS (SELECT n, (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY min(id)) AS j, min(id) AS maker FROM c WHERE kind = 2 GROUP BY n) "
    "SELECT id, CASE kind WHEN 0 THEN n + 1 WHEN 1 THEN n + 1 WHEN 2 THEN j WHEN 4 THEN 7 END::BIGINT AS journal_id, CASE kind WHEN 0 THEN 'exact_title' WHEN 1 THEN 'exact_issn' WHEN 2 THEN CASE WHEN id = maker THEN 'new_journal' ELSE 'exact_title' END WHEN 4 THEN 'by_hand' END AS match_method, "
    "CASE kind WHEN 0 THEN 'accepted' WHEN 1 THEN 'accepted' WHEN 2 THEN CASE WHEN id = maker THEN 'new_journal' ELSE 'accepted' END WHEN 4 THEN 'manually_confirmed' END AS decision, CASE WHEN kind = 3 THEN 'no_usable_title' END AS reason FROM c LEFT JOIN made USING (n)"
)
def resolve_source(spark, sf_dir):
    """The ladder over a whole source: links, decisions and failures. Titles are alike or far apart, so no rung is left to similarity."""
    records = _listed(spark, sf_dir)
    prior = records.where("id % 5 = 4").select(F.lit(2).alias("source_id"), F.lit("abdc_records").alias("source_record_table"), F.col("id").alias("source_record_id"), F.lit(7).alias("journal_id"), F.lit("by_hand").alias("match_method"), F.lit("manually_confirmed").alias("decision"))
    changed = resolve.resolve_source(state.Frames(spark, abdc_records=records, entity_match_decisions=prior, **_dimension(spark, sf_dir)), "ABDC")
    linked = changed["abdc_records"].select("id", "journal_id")
    decided = changed["entity_match_decisions"].select(F.col("source_record_id").alias("id"), "match_method", "decision")
    failed = changed["resolution_failures"].select(F.col("source_record_id").alias("id"), "reason")
    return linked.join(decided, "id", "left").join(failed, "id", "left")


def _reviewed(spark: SparkSession, sf_dir: str):
    """Two candidates a customer, those of some reviewed already, and a reviewer's rows on the others."""
    key = F.col("c_key")
    each = _t(spark, sf_dir, "customer").select((F.col("c_custkey") + 1).alias("c_key"), (F.col("c_nationkey") % 8).alias("c_nationkey"), F.explode(F.array(F.lit(1), F.lit(2))).alias("k"))
    done = key % 5 == 0
    candidates = each.select(
        (key * 2 + F.col("k")).alias("id"), F.lit(2).alias("source_id"), F.lit("abdc_records").alias("source_record_table"), key.alias("source_record_id"), (F.col("c_nationkey") + F.col("k")).alias("candidate_journal_id"), (F.lit(0.97) - F.col("k") / 100).alias("similarity"),
        F.lit("fuzzy_title").alias("match_method"), F.lit(False).alias("issn_match"), F.lit(False).alias("publisher_match"), F.col("k").alias("rank_among_candidates"), F.when(done, F.when(F.col("k") == 1, "accepted").otherwise("rejected")).otherwise("pending").alias("review_status"),
    )
    decision = F.when(key % 4 == 0, "Accepted ").when(key % 4 == 1, "new_journal").when(key % 4 == 2, "rejected_no_match").otherwise(" ")
    rows = each.where("k = 1").select((key * 2 + 1).cast("string").alias("candidate_id"), F.lit("abdc").alias("source"), F.concat(key, F.lit(".0")).alias("source_record_id"), (F.col("c_nationkey") + 1).cast("string").alias("candidate_journal_id"), decision.alias("decision"))
    return state.Frames(spark, abdc_records=_listed(spark, sf_dir).withColumn("journal_name", F.md5(F.concat(F.lit("r"), "id"))), entity_match_candidates=candidates, **_dimension(spark, sf_dir)), rows


@_query(
    "WITH c AS (SELECT c_custkey + 1 AS r, c_nationkey % 8 AS n, (c_custkey + 1) % 5 = 0 AS done, (c_custkey + 1) % 4 AS d FROM customer), made AS (SELECT r, (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY md5('r' || r)) AS j FROM c WHERE NOT done AND d = 1) "
    "SELECT r AS source_record_id, CASE WHEN done OR d = 0 THEN 'accepted' WHEN d = 3 THEN 'pending' ELSE 'rejected' END AS first_status, CASE WHEN NOT done AND d = 3 THEN 'pending' ELSE 'rejected' END AS second_status, CASE WHEN NOT done AND d < 3 THEN 'me' END AS reviewer, "
    "CASE WHEN done THEN NULL WHEN d = 0 THEN 'manually_confirmed' WHEN d = 1 THEN 'new_journal' WHEN d = 2 THEN 'rejected_no_match' END AS decision, CASE WHEN done THEN NULL WHEN d = 0 THEN n + 1 WHEN d = 1 THEN j END::BIGINT AS journal_id, done AND d < 3 AS stale FROM c LEFT JOIN made USING (r)"
)
def review_applied(spark, sf_dir):
    store, rows = _reviewed(spark, sf_dir)
    changed, stale = review.apply_decisions(store, rows, "me")
    queue = changed["entity_match_candidates"]
    first = queue.where("rank_among_candidates = 1").select("source_record_id", F.col("review_status").alias("first_status"), F.col("reviewed_by").alias("reviewer"))
    second = queue.where("rank_among_candidates = 2").select("source_record_id", F.col("review_status").alias("second_status"))
    decided = changed["entity_match_decisions"].select("source_record_id", "decision", "journal_id")
    old = stale.select(((F.col("candidate_id") - 1) / 2).cast("long").alias("source_record_id"), F.lit(True).alias("stale"))
    return first.join(second, "source_record_id").join(decided, "source_record_id", "left").join(old, "source_record_id", "left").withColumn("stale", F.coalesce("stale", F.lit(False)))


@_query(
    "SELECT r * 2 + k AS candidate_id, 'ABDC' AS source, r AS source_record_id, md5('r' || r) AS source_record_display_name, md5((n + k)::VARCHAR) AS candidate_journal_title, (0.97 - k / 100.0)::DECIMAL(5,4) AS similarity, k::SMALLINT AS rank_among_candidates FROM (SELECT c_custkey + 1 AS r, c_nationkey % 8 AS n FROM customer), (VALUES (1), (2)) v(k) WHERE r % 5 <> 0"
)
def pending_queue(spark, sf_dir):
    store, _ = _reviewed(spark, sf_dir)
    queue = review.pending_queue(store.read("entity_match_candidates"), review.display_names(store), store.read("journals"), F.lit("2026-01-01").cast("timestamp"))
    return queue.select("candidate_id", "source", "source_record_id", "source_record_display_name", "candidate_journal_title", "similarity", "rank_among_candidates")


@_query(
    "WITH s AS (SELECT DISTINCT ON (o_custkey, o_orderpriority) o_custkey AS j, o_orderpriority AS area, (o_totalprice / 1000)::DECIMAL(10,3) AS sjr, 'Q' || (o_orderkey % 4 + 1) AS q FROM orders ORDER BY o_custkey, o_orderpriority, year(o_orderdate) DESC, (o_totalprice / 1000)::DECIMAL(10,3) DESC NULLS LAST, o_orderkey DESC), "
    "best AS (SELECT DISTINCT ON (j) j, sjr, q FROM s ORDER BY j, q, sjr DESC NULLS LAST, area), rated AS (SELECT DISTINCT ON (user_id) user_id AS j, CASE event_type WHEN 'click' THEN 'A' ELSE 'B' END AS rating FROM events ORDER BY user_id, event_id % 7 DESC, event_id % 3 DESC, event_id DESC) "
    "SELECT c_custkey AS journal_id, c_name AS canonical_title, c_mktsegment AS publisher, sjr AS scimago_current_sjr, q AS scimago_current_quartile, rating AS abdc_current_rating, c_custkey IN (SELECT s_suppkey * 3 FROM supplier) AS in_ft50 FROM customer LEFT JOIN best ON best.j = c_custkey LEFT JOIN rated ON rated.j = c_custkey"
)
def journal_summary(spark, sf_dir):
    """The summary view: customers as journals, orders as yearly rows, events as ratings."""
    orders = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("journal_id"), F.col("o_orderpriority").alias("subject_area"), F.year("o_orderdate").alias("year"), F.round(F.col("o_totalprice") / 1000, 3).cast("decimal(10,3)").alias("sjr"), F.concat(F.lit("Q"), F.col("o_orderkey") % 4 + 1).alias("sjr_best_quartile"), F.lit(1).alias("h_index"))
    rated = _t(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("journal_id"), (F.col("event_id") % 7).alias("rating_year"), F.when(F.col("event_type") == "click", "A").otherwise("B").alias("rating"), F.lit("").alias("for_code"), F.lit("").alias("for_scheme"), (F.col("event_id") % 3).alias("dataset_id"))
    journals = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("canonical_title"), F.col("c_mktsegment").alias("publisher"))
    return views.journal_summary(journals, orders, rated, _t(spark, sf_dir, "supplier").select((F.col("s_suppkey") * 3).alias("journal_id")))


_ORDER_ROWS = "SELECT o_orderkey AS id, o_custkey AS journal_id, o_orderpriority AS subject_area, year(o_orderdate)::INT AS year, (o_totalprice / 1000)::DECIMAL(10,3) AS sjr, o_orderstatus AS s FROM orders"


@_query(f"SELECT DISTINCT ON (journal_id, subject_area) journal_id, subject_area, year, sjr, id FROM ({_ORDER_ROWS}) WHERE NOT (s = 'P' AND year < 1996) ORDER BY journal_id, subject_area, year DESC, sjr DESC, id DESC")
def current_merged(spark, sf_dir):
    """The current rows of older orders, with later ones merged in and some of the older taken away: as if made of all that are left."""
    rows = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("journal_id"), F.col("o_orderpriority").alias("subject_area"), F.year("o_orderdate").alias("year"), F.round(F.col("o_totalprice") / 1000, 3).cast("decimal(10,3)").alias("sjr"), F.col("o_orderstatus").alias("s"))
    old, added, taken = rows.where("year < 1996"), rows.where("year >= 1996"), F.col("s") == "P"
    state_ = state.durable(views.current(old, "SCIMAGO"))
    return views.merged_current(state_, "SCIMAGO", added, old.where(taken), old.where(~taken)).select("journal_id", "subject_area", "year", "sjr", "id")


# --- title-only sources, coverage, reports as files ----------------------------------------------------------------------


@_query(
    "WITH c AS (SELECT c_custkey + 1 AS id, c_nationkey % 8 AS n, (c_custkey + 1) % 4 AS kind, s FROM customer, (VALUES ('REPEC'), ('FT50')) v(s)), made AS (SELECT s, n, (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (PARTITION BY s ORDER BY min(id)) AS j, min(id) AS maker FROM c WHERE kind = 1 GROUP BY s, n) "
    "SELECT s AS source, id, CASE kind WHEN 0 THEN n + 1 WHEN 1 THEN j END::BIGINT AS journal_id, CASE kind WHEN 0 THEN 'exact_title' WHEN 1 THEN CASE WHEN id = maker THEN 'new_journal' ELSE 'exact_title' END WHEN 2 THEN 'fuzzy_title' END AS match_method, CASE kind WHEN 2 THEN (0.96875)::DECIMAL(5,4) END AS similarity, CASE WHEN kind = 3 THEN 'no_usable_title' END AS reason FROM c LEFT JOIN made USING (s, n)"
)
def resolve_titles(spark, sf_dir):
    """The two sources without identifiers: customers as records with a journal's title, a new one that repeats, one with a letter changed, and none."""
    key, nation, dimension, out = F.col("c_custkey") + 1, F.col("c_nationkey") % 8, _dimension(spark, sf_dir), None
    title = F.md5((nation + 1).cast("string"))
    near = F.concat(F.substring(title, 1, 31), F.lit("z"))
    for source, name in (("REPEC", "journal_name_clean"), ("FT50", "journal_name")):
        records = _t(spark, sf_dir, "customer").select(key.alias("id"), F.when(key % 4 == 0, title).when(key % 4 == 1, F.md5(F.concat(F.lit("new"), nation))).when(key % 4 == 2, near).otherwise("!").alias(name))
        changed = resolve.resolve_source(state.Frames(spark, **{schemas.RECORD_TABLES[source]: records}, **dimension), source)
        decided = changed["entity_match_decisions"].select(F.col("source_record_id").alias("id"), "match_method")
        waiting = changed["entity_match_candidates"].where("review_status = 'pending'").select(F.col("source_record_id").alias("id"), F.col("match_method").alias("method"), "similarity")
        failed = changed["resolution_failures"].select(F.col("source_record_id").alias("id"), "reason")
        part = changed[schemas.RECORD_TABLES[source]].select("id", "journal_id").join(decided, "id", "left").join(waiting, "id", "left").join(failed, "id", "left")
        part = part.select(F.lit(source).alias("source"), "id", "journal_id", F.coalesce("match_method", "method").alias("match_method"), "similarity", "reason")
        out = part if out is None else out.unionByName(part)
    return out


@_query(
    "SELECT CASE c_nationkey % 5 WHEN 0 THEN 'SCIMAGO' WHEN 1 THEN 'ABDC' WHEN 2 THEN 'ABS' WHEN 3 THEN 'REPEC' ELSE 'FT50' END AS source_code, count(*)::BIGINT AS total, count(*) FILTER (WHERE c_custkey % 6 IN (0, 1))::BIGINT AS accepted, count(*) FILTER (WHERE c_custkey % 6 = 2)::BIGINT AS new_journal, count(*) FILTER (WHERE c_custkey % 6 = 3)::BIGINT AS rejected_no_match, count(*) FILTER (WHERE c_custkey % 6 > 3)::BIGINT AS pending, true AS adds_up "
    "FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1"
)
def coverage_run(spark, sf_dir):
    """Customers as records of the five sources, those of one segment in datasets that failed to load, with decisions of every kind."""
    key, of = F.col("c_custkey"), F.col("c_nationkey") % 5
    rows = _t(spark, sf_dir, "customer").select(key.alias("id"), of.alias("of"), (of * 2 + (F.col("c_mktsegment") == "MACHINERY").cast("int")).cast("long").alias("dataset_id"))
    datasets = spark.range(10).select("id", F.when(F.col("id") % 2 == 0, "loaded").otherwise("failed").alias("status"))
    tables = {table: rows.where(F.col("of") == k) for k, table in enumerate(schemas.RECORD_TABLES.values())}
    decision = F.when(key % 6 == 0, "accepted").when(key % 6 == 1, "manually_confirmed").when(key % 6 == 2, "new_journal").when(key % 6 == 3, "rejected_no_match")
    table = F.element_at(F.array(*map(F.lit, schemas.RECORD_TABLES.values())), (of + 1).cast("int"))
    decisions = _t(spark, sf_dir, "customer").select(table.alias("source_record_table"), key.alias("source_record_id"), decision.alias("decision")).where("decision is not null")
    return checks.coverage_of(state.Frames(spark, datasets=datasets, entity_match_decisions=decisions, **tables))


@_query(
    "SELECT 'new' AS form, 'v' || p_size AS identifier, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey) AS journal_ids FROM part GROUP BY p_size "
    "UNION ALL SELECT 'old', 'v' || p_size, string_agg(DISTINCT j::VARCHAR, ',' ORDER BY j::VARCHAR) FROM (SELECT p_size, unnest([min(p_partkey), max(p_partkey)]) AS j FROM part GROUP BY p_size) GROUP BY p_size"
)
def conflict_reports(spark, sf_dir):
    """Parts of a size as the journals of a conflict, written in both forms of the report and read back."""
    folder, out = _folder(spark), None
    groups = _t(spark, sf_dir, "part").groupBy("p_size").agg(F.array_sort(F.collect_list("p_partkey")).alias("ids"), F.min("p_partkey").alias("low"), F.max("p_partkey").alias("high"))
    new = groups.select(F.lit("new").alias("file"), F.concat(F.lit("v"), "p_size").alias("identifier"), F.array_join(F.reverse(F.col("ids")).cast("array<string>"), ";").alias("journal_ids"), F.lit("line one\nline two").alias("message"))
    old = groups.select(F.lit("old").alias("file"), F.concat(F.lit("v"), "p_size").alias("normalized_issn"), F.concat(F.lit("claimed by journal "), "high", F.lit(", kept by journal_id="), "low").alias("message"))
    for form, df, order in (("new", new, "identifier"), ("old", old, "normalized_issn")):
        _csv_files(df, f"{folder}/{form}", "file", order)
        read = delimited.read_conflict_csv(spark, f"{folder}/{form}/{form}.csv")
        ids = F.col("journal_ids") if form == "new" else F.array_sort(F.col("journal_ids").cast("array<string>"))
        part = read.select(F.lit(form).alias("form"), "identifier", F.array_join(ids.cast("array<string>"), ",").alias("journal_ids"))
        out = part if out is None else out.unionByName(part)
    return out


@_query(
    "SELECT c_custkey + 1 AS candidate_id, array_to_string(list_filter([CASE WHEN c_nationkey = 3 THEN 'invalid_source' END, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'invalid_decision' END], lambda x: x IS NOT NULL), ',') AS problems FROM customer WHERE c_mktsegment <> 'BUILDING'"
)
def review_file(spark, sf_dir):
    """Customers as rows of a reviewer's file, with line breaks and columns of the reviewer's own, read back and checked."""
    key = (F.col("c_custkey") + 1).cast("string")
    decision = F.when(F.col("c_mktsegment") == "BUILDING", " ").when(F.col("c_mktsegment") == "MACHINERY", "perhaps").otherwise("Accepted ")
    rows = _t(spark, sf_dir, "customer").select(F.lit("queue").alias("file"), key.alias("candidate_id"), F.when(F.col("c_nationkey") == 3, "NONE").otherwise("ft50").alias("source"), key.alias("source_record_id"), F.lit("8").alias("candidate_journal_id"), decision.alias("decision"), F.concat("c_name", F.lit('\nsaid "so", twice')).alias("note"))
    folder = _folder(spark)
    _csv_files(rows, folder, "file", "candidate_id")
    return review.check_rows(delimited.read_review_csv(spark, f"{folder}/queue.csv")).select("candidate_id", F.array_join("problems", ",").alias("problems"))
