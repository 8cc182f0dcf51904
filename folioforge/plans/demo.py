"""Queries over the supplied tables, one or more for each operator, with the same as SQL for DuckDB.

The journal sources aren't among these tables, so each operator works on columns of the same shape: names for titles,
orders for yearly observations, parts for records. Every query looks at whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import similarity as sim
from ..operators import candidates as C
from ..operators import checks, resolve, state
from ..sources import delimited
from . import views

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
#: White space for DuckDB's patterns, as in functions.scalars.
_WS = "[\\x09-\\x0d\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"


def _clean(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_WS}', ' ', 'g'))"


def _key(x: str) -> str:
    lowered = f"replace(lower({_clean(x)}), '&', ' and ')"
    bare = f"regexp_replace({lowered}, '\\p{{P}}', '', 'g')"
    return f"regexp_replace({_clean(bare)}, '^(the|a|an) ', '')"


def _query(sql: str | None = None):
    def keep(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return keep


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- scalar functions ---------------------------------------------------------------------------------------------------


@_query(f"SELECT doc_id, md5(coalesce({_clean('text')}, '')) AS clean_md5, length(coalesce({_clean('text')}, ''))::BIGINT AS clean_chars FROM documents")
def title_clean(spark, sf_dir):
    clean = S.clean_whitespace("text")
    return _t(spark, sf_dir, "documents").select("doc_id", F.md5(clean).alias("clean_md5"), F.length(clean).cast("long").alias("clean_chars"))


@_query(f"SELECT doc_id, md5({_key('text')}) AS key_md5 FROM documents")
def title_match_key(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.md5(S.matching_title("text")).alias("key_md5"))


_RAW_ISSN = "concat(substr(lpad(cast(s_suppkey * 7919 % 10000000 AS varchar), 7, '0'), 1, 4), '-', substr(lpad(cast(s_suppkey * 7919 % 10000000 AS varchar), 7, '0'), 5, 3), substr('0123456789Xx-y', cast(s_suppkey % 14 AS int) + 1, 1))"
_NORM = "CASE WHEN regexp_matches(upper(replace(raw, '-', '')), '^[0-9]{7}[0-9X]$') THEN upper(replace(raw, '-', '')) END"


def _raw_issn():
    digits = F.lpad((F.col("s_suppkey") * 7919 % 10000000).cast("string"), 7, "0")
    return F.concat(F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 3), F.substring(F.lit("0123456789Xx-y"), (F.col("s_suppkey") % 14).cast("int") + 1, F.lit(1)))


@_query(f"SELECT s_suppkey, raw, {_NORM} AS issn FROM (SELECT s_suppkey, {_RAW_ISSN} AS raw FROM supplier)")
def issn_normalize(spark, sf_dir):
    return _t(spark, sf_dir, "supplier").select("s_suppkey", _raw_issn().alias("raw")).select("s_suppkey", "raw", S.normalize_issn("raw").alias("issn"))


@_query(
    f"SELECT s_suppkey, coalesce((list_sum([cast(substr(issn, i, 1) AS int) * (9 - i) FOR i IN range(1, 8)]) + CASE substr(issn, 8, 1) WHEN 'X' THEN 10 ELSE cast(substr(issn, 8, 1) AS int) END) % 11 = 0, false) AS valid "
    f"FROM (SELECT s_suppkey, {_NORM} AS issn FROM (SELECT s_suppkey, {_RAW_ISSN} AS raw FROM supplier))"
)
def issn_checksum(spark, sf_dir):
    return _t(spark, sf_dir, "supplier").select("s_suppkey", S.issn_checksum(_raw_issn()).alias("valid"))


@_query(
    f"SELECT s_suppkey, issn FROM (SELECT s_suppkey, unnest([{_NORM.replace('raw', 'x')} FOR x IN [raw, ' ' || raw, 'n/a', '1533-628X']]) AS issn FROM (SELECT s_suppkey, {_RAW_ISSN} AS raw FROM supplier)) WHERE issn IS NOT NULL".replace("replace(x, '-', '')", "replace(trim(x), '-', '')")
)
def multi_split(spark, sf_dir):
    text = F.concat(_raw_issn(), F.lit(", "), _raw_issn(), F.lit(",n/a,1533-628X"))
    return _t(spark, sf_dir, "supplier").select("s_suppkey", F.explode(S.split_multi_issn(text)).alias("issn"))


@_query(
    "SELECT p_partkey, CASE WHEN regexp_matches(c, '^(.*)\\s\\((Q[1-4])\\)$') THEN regexp_extract(c, '^(.*)\\s\\((Q[1-4])\\)$', 1) ELSE c END AS category_name, nullif(regexp_extract(c, '^(.*)\\s\\((Q[1-4])\\)$', 2), '') AS quartile "
    "FROM (SELECT p_partkey, unnest([concat(p_type, ' (Q', p_size % 6, ')'), p_name]) AS c FROM part)"
)
def category_parse(spark, sf_dir):
    text = F.concat("p_type", F.lit(" (Q"), F.col("p_size") % 6, F.lit(");  "), "p_name", F.lit(" ;"))
    return _t(spark, sf_dir, "part").select("p_partkey", F.explode(S.parse_categories(text)).alias("c")).select("p_partkey", "c.category_name", "c.quartile")


@_query("SELECT p_partkey, area FROM (SELECT p_partkey, unnest([p_type, p_name]) AS area FROM part)")
def area_parse(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", F.explode(S.parse_areas(F.concat("p_type", F.lit(" ; ;"), "p_name", F.lit(";")))).alias("area"))


_SUFFIXED = "CASE p_size % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name || ', ' || p_brand || ' Press' WHEN 2 THEN p_name || ', Theory and Practice' ELSE p_name || ',' END"


@_query(
    f"SELECT p_partkey, CASE WHEN p_size % 4 = 1 THEN p_name ELSE whole END AS name, CASE WHEN p_size % 4 = 1 THEN p_brand || ' Press' END AS publisher, CASE p_size % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'high' ELSE 'low' END AS confidence FROM (SELECT *, {_SUFFIXED} AS whole FROM part)"
)
def suffix_split(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", S.split_publisher(F.expr(_SUFFIXED)).alias("s")).select("p_partkey", "s.*")


@_query("SELECT c_custkey, cast(cast(c_acctbal AS decimal(12,2)) AS decimal(14,3)) AS value FROM customer")
def decimal_comma(spark, sf_dir):
    text = F.regexp_replace(F.col("c_acctbal").cast("decimal(12,2)").cast("string"), "\\.", ",")
    return _t(spark, sf_dir, "customer").select("c_custkey", S.parse_decimal_comma(text).cast("decimal(14,3)").alias("value"))


@_query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_id WHEN event_id % 3 = 1 AND event_id % 10 = 0 THEN event_id // 10 END AS whole, CASE WHEN event_id % 3 = 0 AND event_id BETWEEN 1000 AND 9999 THEN event_id::INT WHEN event_id % 3 = 1 AND event_id % 10 = 0 AND event_id // 10 BETWEEN 1000 AND 9999 THEN (event_id // 10)::INT END AS year FROM events")
def int_and_year(spark, sf_dir):
    text = F.expr("CASE event_id % 3 WHEN 0 THEN concat(event_id, '.0') WHEN 1 THEN concat(event_id div 10, '.', event_id % 10) ELSE concat(event_id, ' items') END")
    return _t(spark, sf_dir, "events").select("event_id", S.parse_int(text).alias("whole"), S.parse_year(text).alias("year"))


@_query("SELECT c_custkey, CASE WHEN c_nationkey % 5 BETWEEN 1 AND 4 THEN 'Q' || (c_nationkey % 5) END AS quartile, CASE c_nationkey % 6 WHEN 0 THEN 'A*' WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 3 THEN 'C' END AS rating, c_nationkey % 3 = 0 AS open_access FROM customer")
def ratings_and_flags(spark, sf_dir):
    quartile, rating = F.concat(F.lit(" q"), F.col("c_nationkey") % 5), F.element_at(F.array(*map(F.lit, ("a* ", "A", "b", " c", "D", ""))), F.col("c_nationkey") % 6 + 1)
    answer = F.element_at(F.array(F.lit("YES "), F.lit("no"), F.lit("")), F.col("c_nationkey") % 3 + 1)
    return _t(spark, sf_dir, "customer").select("c_custkey", S.quartile(quartile).alias("quartile"), S.abdc_rating(rating).alias("rating"), S.yes(answer).alias("open_access"))


@_query("SELECT s_suppkey, 1990 + s_nationkey AS year, CASE WHEN s_suppkey % 3 < 2 THEN 'Nation ' || s_nationkey || ' - Arts' END AS subject_area FROM supplier WHERE s_suppkey % 3 < 2 UNION ALL SELECT s_suppkey, NULL, NULL FROM supplier WHERE s_suppkey % 3 = 2")
def filename_parse(spark, sf_dir):
    year, area = (F.col("s_nationkey") + 1990).cast("string"), F.concat(F.lit("Nation "), "s_nationkey", F.lit(" - Arts"))
    name = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("file:/raw/scimagojr "), year, F.lit("  Subject Area - "), area, F.lit(".csv"))).when(F.col("s_suppkey") % 3 == 1, F.concat(F.lit("/raw/SCIMAGOJR%20"), year, F.lit("%20%20Subject%20Area%20-%20"), F.replace(area, F.lit(" "), F.lit("%20")), F.lit(".CSV"))).otherwise(F.concat(F.lit("scimagojr_"), year, F.lit("__Subject_Area.csv")))
    found = delimited.parse_file_name(name)
    return _t(spark, sf_dir, "supplier").select("s_suppkey", found["year"].alias("year"), found["subject_area"].alias("subject_area"))


@_query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 1 OR o_custkey = o_orderkey THEN o_custkey::VARCHAR ELSE least(o_custkey, o_orderkey) || ',' || greatest(o_custkey, o_orderkey) END AS ids FROM orders")
def conflict_ids(spark, sf_dir):
    listed = F.when(F.col("o_orderkey") % 2 == 0, F.concat_ws(";", "o_custkey", "o_orderkey", "o_custkey"))
    message = F.concat(F.lit("identifier X already belongs to journal "), "o_custkey")
    return _t(spark, sf_dir, "orders").select("o_orderkey", F.array_join(S.journal_ids_of(listed, message).cast("array<string>"), ",").alias("ids"))


@_query("SELECT c_custkey, coalesce(CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END, CASE WHEN c_nationkey % 3 = 0 THEN c_name END) AS first_value FROM customer")
def first_non_empty(spark, sf_dir):
    df = _t(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment")).otherwise(F.lit(" \t")).alias("a"), F.when(F.col("c_nationkey") % 3 == 0, F.col("c_name")).alias("b"))
    return df.select("c_custkey", S.first_non_empty(["a", "absent", "b"], df.columns).alias("first_value"))


@_query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY sha256(coalesce(text, '')) ORDER BY doc_id) AS n FROM documents) WHERE n = 1")
def row_hash_dedupe(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", S.row_hash(["text"]).alias("hash"))
    return docs.groupBy("hash").agg(F.min("doc_id").alias("doc_id")).select("doc_id")


@_query("SELECT p_partkey, array_to_string(list_sort(string_split(p_name || ' ' || lower(p_type), ' ')), ' ') AS sorted, substr(p_name, 1, 4) AS block FROM part")
def token_sort(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", sim.token_sort(F.concat_ws(" ", "p_name", F.lower("p_type"))).alias("sorted"), sim.title_block_of("p_name").alias("block"))


# --- projections, filters, unpivot --------------------------------------------------------------------------------------


@_query("SELECT o_orderkey, kind, value FROM (SELECT o_orderkey, unnest([{'kind': 'AJG2018', 'value': o_orderpriority}, {'kind': 'AJG2021', 'value': nullif(o_orderstatus, 'P')}], recursive := true) FROM orders) WHERE value IS NOT NULL")
def wide_to_long(spark, sf_dir):
    from ..operators.transforms import unpivot_abs

    wide = _t(spark, sf_dir, "orders").select(F.lit("f").alias("_file"), F.col("o_orderkey").alias("_row_number"), F.col("o_orderpriority").alias("AJG2018"), F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.col("o_orderstatus")).alias("AJG2021"))
    return unpivot_abs(wide).select(F.col("_row_number").alias("o_orderkey"), F.concat(F.lit("AJG"), "rating_year").alias("kind"), F.col("rating").alias("value"))


@_query(
    "SELECT l_orderkey, l_linenumber, unnest(list_filter([CASE WHEN l_quantity > 45 THEN 'quantity_out_of_range' END, CASE WHEN l_discount > 0.08 THEN 'discount_out_of_range' END, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'invalid_status' END], lambda x: x IS NOT NULL)) AS reason FROM lineitem"
)
def validate_rejects(spark, sf_dir):
    from ..operators.transforms import problems

    tests = {"quantity_out_of_range": ~S.in_range("l_quantity", 0, 45), "discount_out_of_range": ~S.in_range("l_discount", 0, 0.08), "invalid_status": (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")}
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.explode(problems(tests)).alias("reason"))


# --- views --------------------------------------------------------------------------------------------------------------


@_query("SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_orderdate::DATE AS latest, o_totalprice FROM orders ORDER BY o_custkey, o_orderdate DESC, o_totalprice DESC NULLS LAST, o_orderkey DESC")
def latest_per_key(spark, sf_dir):
    found = views.latest(_t(spark, sf_dir, "orders"), ["o_custkey"], [F.desc_nulls_first("o_orderdate"), F.desc_nulls_last("o_totalprice"), F.desc("o_orderkey")])
    return found.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("latest"), "o_totalprice")


@_query("SELECT DISTINCT ON (o_custkey, o_orderpriority) o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderpriority, o_orderdate DESC, o_totalprice DESC NULLS LAST, o_orderkey DESC")
def latest_per_key_and_area(spark, sf_dir):
    found = views.latest(_t(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"], [F.desc_nulls_first("o_orderdate"), F.desc_nulls_last("o_totalprice"), F.desc("o_orderkey")])
    return found.select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")


@_query(
    "SELECT c_custkey, c_name, EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey) AS has_orders, EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey) AS has_events, EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT') AS has_urgent FROM customer c"
)
def availability_flags(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    events = _t(spark, sf_dir, "events").withColumnRenamed("user_id", "c_custkey")
    base = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return views.flags(base, "c_custkey", {"has_orders": orders, "has_events": events, "has_urgent": orders.where("o_orderpriority = '1-URGENT'")})


@_query(
    """
WITH latest AS (SELECT DISTINCT ON (o_custkey, o_orderpriority) o_custkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_custkey, o_orderpriority, o_orderdate DESC, o_totalprice DESC NULLS LAST, o_orderkey DESC)
SELECT c.c_custkey, c.c_name, best.o_totalprice AS current_price, best.o_orderpriority AS current_priority, EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey) AS in_events
FROM customer c LEFT JOIN LATERAL (
  SELECT o_totalprice, o_orderpriority FROM latest v WHERE v.o_custkey = c.c_custkey
  ORDER BY CASE left(v.o_orderpriority, 1) WHEN '1' THEN 1 WHEN '2' THEN 2 WHEN '3' THEN 3 WHEN '4' THEN 4 ELSE 5 END, v.o_totalprice DESC NULLS LAST, v.o_orderpriority LIMIT 1) best ON TRUE"""
)
def summary_headline(spark, sf_dir):
    """The flagship: each customer with the best of its current orders by priority, and a flag."""
    order = [F.desc_nulls_first("o_orderdate"), F.desc_nulls_last("o_totalprice"), F.desc("o_orderkey")]
    current = views.latest(_t(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"], order)
    rank = views.quartile_rank(F.concat(F.lit("Q"), F.substring("o_orderpriority", 1, 1)))
    best = views.latest(current, ["o_custkey"], [rank, F.desc_nulls_last("o_totalprice"), F.asc("o_orderpriority")])
    best = best.select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("current_price"), F.col("o_orderpriority").alias("current_priority"))
    base = _t(spark, sf_dir, "customer").select("c_custkey", "c_name").join(best, "c_custkey", "left")
    return views.flags(base, "c_custkey", {"in_events": _t(spark, sf_dir, "events").withColumnRenamed("user_id", "c_custkey")})


# --- aggregation and checks ---------------------------------------------------------------------------------------------


@_query(
    "WITH y AS (SELECT DISTINCT o_custkey, year(o_orderdate)::INT AS y FROM orders) SELECT a.o_custkey, (a.y + 1)::INT AS missing_year, a.y AS previous_year, b.y AS next_year FROM y a JOIN y b ON b.o_custkey = a.o_custkey AND b.y = a.y + 2 LEFT JOIN y m ON m.o_custkey = a.o_custkey AND m.y = a.y + 1 WHERE m.y IS NULL"
)
def history_gaps(spark, sf_dir):
    return checks.history_gaps(_t(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate")), "o_custkey", "y")


@_query("SELECT p_name, count(*)::BIGINT AS row_count FROM part GROUP BY p_name HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return checks.duplicate_keys(_t(spark, sf_dir, "part"), ["p_name"])


@_query("SELECT o_custkey, o_orderkey, y FROM (SELECT *, year(o_orderdate)::INT AS y, row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END, lower(o_orderpriority), o_orderpriority, o_orderkey) AS n FROM orders) WHERE n = 1")
def representative_row(spark, sf_dir):
    from ..operators.canonical import representative

    rows = _t(spark, sf_dir, "orders").withColumns({"y": F.year("o_orderdate"), "publisher": F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.col("o_orderstatus"))})
    return representative(rows, "o_custkey", "y", "publisher", "o_orderpriority", "o_orderkey").select("o_custkey", "o_orderkey", "y")


@_query(
    "WITH r AS (SELECT p_brand, max_by(p_name, p_partkey) AS shown FROM part GROUP BY p_brand) SELECT p.p_brand, v AS variant FROM (SELECT p_brand, unnest(list_distinct(list(p_name))) AS v FROM part GROUP BY p_brand) p JOIN r USING (p_brand) WHERE v <> shown"
)
def title_variants(spark, sf_dir):
    from ..operators import canonical

    parts = _t(spark, sf_dir, "part")
    chosen = parts.groupBy("p_brand").agg(F.max_by("p_name", "p_partkey").alias("shown"))
    return canonical.title_variants(parts, chosen, "p_brand", "p_name").select("p_brand", F.explode("variants").alias("variant"))


@_query(
    "SELECT source, count(*)::BIGINT AS total, count(*) FILTER (WHERE decision IN ('accepted', 'manually_confirmed'))::BIGINT AS accepted, count(*) FILTER (WHERE decision = 'new_journal')::BIGINT AS new_journal, count(*) FILTER (WHERE decision = 'rejected_no_match')::BIGINT AS rejected_no_match, count(*) FILTER (WHERE decision IS NULL)::BIGINT AS pending, true AS adds_up "
    "FROM documents LEFT JOIN (SELECT doc_id, CASE WHEN toxic = 1 THEN 'rejected_no_match' WHEN quality = 1 THEN 'accepted' WHEN doc_id % 2 = 0 THEN 'manually_confirmed' ELSE 'new_journal' END AS decision FROM labels) USING (doc_id) GROUP BY source"
)
def coverage_taxonomy(spark, sf_dir):
    decision = F.when(F.col("toxic") == 1, "rejected_no_match").when(F.col("quality") == 1, "accepted").when(F.col("doc_id") % 2 == 0, "manually_confirmed").otherwise("new_journal")
    return checks.coverage(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels").select("doc_id", decision.alias("decision")), ["doc_id"], "source")


@_query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 500")
def ordered_sample(spark, sf_dir):
    return checks.ordered_sample(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@_query(
    "WITH refs AS (SELECT 'part' AS source_record_table, l_partkey * 2 AS source_record_id, count(*)::BIGINT AS n FROM lineitem GROUP BY ALL UNION ALL SELECT CASE WHEN doc_id % 7 = 0 THEN 'attic' ELSE 'supplier' END, doc_id, 1 FROM labels) "
    "SELECT r.*, CASE WHEN source_record_table IN ('part', 'supplier') THEN 'source_record_missing' ELSE 'unknown_source_table' END AS reason FROM refs r WHERE NOT EXISTS (SELECT 1 FROM part WHERE r.source_record_table = 'part' AND p_partkey = source_record_id) AND NOT EXISTS (SELECT 1 FROM supplier WHERE r.source_record_table = 'supplier' AND s_suppkey = source_record_id)"
)
def dangling_refs(spark, sf_dir):
    parts = _t(spark, sf_dir, "lineitem").groupBy((F.col("l_partkey") * 2).alias("source_record_id")).agg(F.count("*").alias("n")).select(F.lit("part").alias("source_record_table"), "source_record_id", "n")
    others = _t(spark, sf_dir, "labels").select(F.when(F.col("doc_id") % 7 == 0, "attic").otherwise("supplier").alias("source_record_table"), F.col("doc_id").alias("source_record_id"), F.lit(1).cast("long").alias("n"))
    tables = {"part": _t(spark, sf_dir, "part").withColumnRenamed("p_partkey", "id"), "supplier": _t(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "id")}
    return checks.dangling(parts.unionByName(others), tables, None)


# --- joins and resolution -----------------------------------------------------------------------------------------------


@_query(f"WITH dim AS (SELECT {_key("p_name || ' ' || p_size")} AS k, min(p_partkey) AS journal_id FROM part GROUP BY 1) SELECT p_partkey AS id, journal_id FROM part JOIN dim ON k = {_key("upper(p_name) || ' ' || (p_size + 1)")}")
def exact_title_match(spark, sf_dir):
    parts = _t(spark, sf_dir, "part")
    dim = parts.groupBy(S.matching_title(F.concat_ws(" ", "p_name", "p_size")).alias("normalized_title")).agg(F.min("p_partkey").alias("journal_id"))
    return resolve.by_title(parts.select(F.col("p_partkey").alias("id"), S.matching_title(F.concat_ws(" ", F.upper("p_name"), F.col("p_size") + 1)).alias("key")), dim)


@_query(
    "WITH dim AS (SELECT DISTINCT p_brand || '/' || p_size || '/' || p_type AS v, p_partkey AS j FROM part), hits AS (SELECT p_partkey AS id, v, count(DISTINCT j) AS n, min(j) AS j FROM part JOIN dim ON v IN (p_brand || '/' || p_size || '/' || p_type, p_brand || '/' || (p_size + 1) || '/' || p_type) GROUP BY ALL) "
    "SELECT id, min(j) AS journal_id FROM hits WHERE n = 1 GROUP BY id HAVING count(DISTINCT j) = 1"
)
def id_lookup(spark, sf_dir):
    parts = _t(spark, sf_dir, "part")
    dim = parts.select(F.concat_ws("/", "p_brand", "p_size", "p_type").alias("normalized_value"), F.col("p_partkey").alias("journal_id"))
    records = parts.select(F.col("p_partkey").alias("id"), F.array(F.concat_ws("/", "p_brand", "p_size", "p_type"), F.concat_ws("/", "p_brand", F.col("p_size") + 1, "p_type")).alias("issns"))
    return resolve.by_identifier(records, dim)[0]


@_query("SELECT v AS identifier, journal_ids FROM (SELECT p_brand || '/' || p_size AS v, string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey) AS journal_ids, count(*) AS n FROM part GROUP BY 1) WHERE n > 1")
def id_conflicts(spark, sf_dir):
    parts = _t(spark, sf_dir, "part")
    dim = parts.select(F.concat_ws("/", "p_brand", "p_size").alias("normalized_value"), F.col("p_partkey").alias("journal_id"))
    found = resolve.by_identifier(parts.select(F.col("p_partkey").alias("id"), F.array(F.concat_ws("/", "p_brand", "p_size")).alias("issns")), dim)[1]
    return found.select("identifier", F.array_join(F.col("journal_ids").cast("array<string>"), ",").alias("journal_ids"))


#: Titles of parts, and length of the longest common subsequence of pairs (a, b) by rows of the table kept as lists.
_TITLES = "titles AS (SELECT DISTINCT p_name || ' ' || lower(p_type) AS k FROM part), sorted AS (SELECT k, array_to_string(list_sort(string_split(k, ' ')), ' ') AS s FROM titles)"
_LCS = """
steps(key, other, a, b, i, r) AS (
  SELECT key, other, a, b, 0, list_transform(range(0, length(b) + 1), lambda x: 0) FROM pairs
  UNION ALL
  SELECT key, other, a, b, i + 1, list_transform(range(1, length(b) + 2), lambda j: list_max(list_transform(range(1, j + 1), lambda m: CASE WHEN m = 1 THEN 0 ELSE greatest(r[m], r[m - 1] + CASE WHEN substr(b, (m - 1)::INT, 1) = substr(a, i + 1, 1) THEN 1 ELSE 0 END) END)))
  FROM steps WHERE i < length(a)),
scored AS (SELECT key, other, 2.0::DOUBLE * r[length(b) + 1] / (length(a) + length(b)) AS score FROM steps WHERE i = length(a) AND 20 * r[length(b) + 1] >= 9 * (length(a) + length(b)))"""


@_query(
    f"WITH RECURSIVE {_TITLES}, pairs AS (SELECT x.k AS key, y.k AS other, x.s AS a, y.s AS b FROM sorted x JOIN sorted y ON substr(x.k, 1, 4) = substr(y.k, 1, 4) WHERE 20 * least(length(x.k), length(y.k)) >= 9 * (length(x.k) + length(y.k))), {_LCS} "
    "SELECT key, other, cast(score AS decimal(18,10)) AS score, n FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY score DESC, other) AS n FROM scored) WHERE n <= 5"
)
def fuzzy_block_match(spark, sf_dir):
    titles = _t(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", F.lower("p_type")).alias("key")).distinct()
    pairs = resolve.similar_titles(titles, titles.withColumnRenamed("key", "other"))
    ranked = pairs.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "other")).cast("long"))
    return ranked.where("n <= 5").select("key", "other", F.col("score").cast("decimal(18,10)").alias("score"), "n")


#: The first words of a document as a title, and as that of a record whose last letter differs.
_DOC_TITLES = "named AS (SELECT doc_id, n_chars, lower(array_to_string(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+')[1:6], ' ')) AS t FROM documents)"
_SORTED = "array_to_string(list_sort(string_split({}, ' ')), ' ')"


def _doc_titles(spark, sf_dir):
    words = F.slice(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Za-z]+"), F.lit(0)), 1, 6)
    return _t(spark, sf_dir, "documents").select("doc_id", "n_chars", F.lower(F.array_join(words, " ")).alias("t"))


@_query(
    f"WITH RECURSIVE {_DOC_TITLES}, dim AS (SELECT t, min(doc_id) AS journal_id FROM named WHERE t <> '' GROUP BY 1), asked AS (SELECT doc_id AS id, substr(t, 1, length(t) - 1) || 's' AS q FROM named WHERE length(t) > 1), "
    f"pairs AS (SELECT q AS key, t AS other, {_SORTED.format('q')} AS a, {_SORTED.format('t')} AS b FROM (SELECT DISTINCT q FROM asked) JOIN dim ON substr(q, 1, 4) = substr(t, 1, 4) AND 20 * least(length(q), length(t)) >= 9 * (length(q) + length(t))), {_LCS} "
    "SELECT id, journal_id, cast(score AS decimal(18,10)) AS score, rank FROM (SELECT id, journal_id, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, journal_id) AS rank FROM asked JOIN scored ON q = key JOIN dim ON t = other) WHERE rank <= 5"
)
def fuzzy_document_titles(spark, sf_dir):
    named = _doc_titles(spark, sf_dir)
    dim = named.where("t <> ''").groupBy(F.col("t").alias("normalized_title")).agg(F.min("doc_id").alias("journal_id"))
    records = named.where("length(t) > 1").select(F.col("doc_id").alias("id"), F.concat(F.expr("substr(t, 1, length(t) - 1)"), F.lit("s")).alias("key"))
    return resolve.fuzzy_titles(records, dim).select("id", "journal_id", F.col("score").cast("decimal(18,10)").alias("score"), F.col("rank").cast("long").alias("rank"))


#: Records by what becomes of them: as a title with a letter or words more, as a hexadecimal digest that is like no other title.
_RECORD_KEY = "CASE n_chars % 4 WHEN 0 THEN t WHEN 1 THEN t || 's' WHEN 2 THEN t || ' vol' ELSE md5(doc_id::VARCHAR) END"


@_query(
    f"WITH RECURSIVE {_DOC_TITLES}, dim AS (SELECT t, min(doc_id) AS journal_id FROM named WHERE t <> '' GROUP BY 1), asked AS (SELECT doc_id AS id, {_RECORD_KEY} AS q, 'v' || doc_id AS v FROM named WHERE t <> ''), "
    "owner AS (SELECT 'v' || max(doc_id) AS v, min(doc_id) AS journal_id FROM named WHERE t <> '' GROUP BY t HAVING count(*) > 1), "
    f"pairs AS (SELECT q AS key, t AS other, {_SORTED.format('q')} AS a, {_SORTED.format('t')} AS b FROM (SELECT DISTINCT q FROM asked) JOIN dim ON substr(q, 1, 4) = substr(t, 1, 4) AND 20 * least(length(q), length(t)) >= 9 * (length(q) + length(t))), {_LCS}, "
    "best AS (SELECT key, journal_id AS near, round(cast(score AS decimal(18,10)), 4) AS s FROM (SELECT key, journal_id, score, row_number() OVER (PARTITION BY key ORDER BY score DESC, journal_id) AS n FROM scored JOIN dim ON t = other) WHERE n = 1), "
    "found AS (SELECT id, o.journal_id AS by_id, d.journal_id AS by_title, near, s FROM asked LEFT JOIN owner o USING (v) LEFT JOIN dim d ON q = t LEFT JOIN best ON q = key), "
    "told AS (SELECT *, CASE WHEN by_id IS NOT NULL THEN 'exact_issn' WHEN by_title IS NOT NULL THEN 'exact_title' WHEN s IS NOT NULL THEN 'fuzzy_title' ELSE 'new_journal' END AS match_method FROM found) "
    "SELECT id, match_method, CASE match_method WHEN 'fuzzy_title' THEN CASE WHEN s >= 0.97 THEN 'accepted' ELSE 'pending' END WHEN 'new_journal' THEN 'new_journal' ELSE 'accepted' END AS outcome, "
    "CASE match_method WHEN 'exact_issn' THEN by_id WHEN 'exact_title' THEN by_title WHEN 'fuzzy_title' THEN CASE WHEN s >= 0.97 THEN near END ELSE 999999999 + row_number() OVER (PARTITION BY match_method ORDER BY id) END AS journal_id FROM told"
)
def resolve_documents(spark, sf_dir):
    """The whole ladder where similarity decides but the order of records doesn't: what makes journals is like no other title."""
    named = _doc_titles(spark, sf_dir).where("t <> ''")
    dim = named.groupBy(F.col("t").alias("normalized_title")).agg(F.min("doc_id").alias("id"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
    identifiers = dim.where("n > 1").select(F.col("id").alias("journal_id"), F.lit("ISSN").alias("identifier_type"), F.concat(F.lit("v"), "last").alias("normalized_value"))
    kind = F.col("n_chars") % 4
    key = F.when(kind == 0, F.col("t")).when(kind == 1, F.concat("t", F.lit("s"))).when(kind == 2, F.concat("t", F.lit(" vol"))).otherwise(F.md5(F.col("doc_id").cast("string").cast("binary")))
    records = named.select(F.col("doc_id").alias("id"), key.alias("key"), F.array(F.concat(F.lit("v"), "doc_id")).alias("issns"))
    return resolve.resolve_records(records, dim.select("id", "normalized_title"), identifiers, 1_000_000_000).outcomes.select("id", "match_method", "outcome", "journal_id")


@_query(
    f"WITH RECURSIVE {_TITLES}, accepted AS (SELECT min(p_partkey) AS id, p_name || ' ' || lower(p_type) AS k, (0.90 + min(p_partkey) % 11 / 100.0)::DECIMAL(5,4) AS stored FROM part GROUP BY p_name, p_type), "
    "asked AS (SELECT id, k || CASE WHEN id % 3 = 0 THEN ' deluxe' ELSE '' END AS q, k, stored FROM accepted), "
    "pairs AS (SELECT DISTINCT q AS key, y.k AS other, array_to_string(list_sort(string_split(q, ' ')), ' ') AS a, y.s AS b FROM asked JOIN sorted y ON substr(q, 1, 4) = substr(y.k, 1, 4)), "
    + _LCS.replace(" AND 20 * r[length(b) + 1] >= 9 * (length(a) + length(b))", "")
    + ", best AS (SELECT key, other, score FROM (SELECT s.*, row_number() OVER (PARTITION BY key ORDER BY score DESC, t.id) AS n FROM scored s JOIN accepted t ON t.k = s.other) WHERE n = 1), "
    "joined AS (SELECT id, stored, other = k AS same, round(cast(score AS decimal(18,10)), 4)::DECIMAL(5,4) AS again FROM asked JOIN best ON key = q) "
    "SELECT id AS source_record_id, stored AS accepted_score, CASE WHEN same THEN again END AS recomputed_score, CASE WHEN same THEN 'score_drop' ELSE 'not_recomputable' END AS reason FROM joined WHERE NOT same OR stored - again >= 0.05"
)
def drift_check(spark, sf_dir):
    parts = _t(spark, sf_dir, "part").groupBy("p_name", "p_type").agg(F.min("p_partkey").alias("id")).withColumn("title", F.concat_ws(" ", "p_name", F.lower("p_type")))
    stored = (F.lit(0.90).cast("decimal(5,4)") + (F.col("id") % 11 / 100).cast("decimal(5,4)")).cast("decimal(5,4)")
    accepted = parts.select(F.lit("part").alias("source_record_table"), F.col("id").alias("source_record_id"), F.col("id").alias("journal_id"), stored.alias("accepted_score"), F.lit(None).cast("timestamp").alias("accepted_at"), F.concat("title", F.when(F.col("id") % 3 == 0, " deluxe").otherwise("")).alias("key"))
    found = checks.match_drift(accepted, parts.select(F.col("id").alias("journal_id"), F.col("title").alias("normalized_title")))
    return found.select("source_record_id", "accepted_score", "recomputed_score", "reason")


@_query(
    "WITH e AS (SELECT l_partkey AS r, l_suppkey AS j, max((l_quantity / 50)::DECIMAL(5,4)) AS s, bool_or(l_returnflag = 'R') AS f, min(l_linenumber) AS k, bool_or(l_linestatus = 'O') AS o, bool_or(l_linestatus = 'F') AS p FROM lineitem GROUP BY ALL) "
    "SELECT r, j, s AS similarity, f AS issn_match, CASE WHEN o AND p THEN 'exact_title_ambiguous+fuzzy_title' WHEN o THEN 'fuzzy_title' ELSE 'exact_title_ambiguous' END AS match_method, k AS rank_among_candidates FROM e"
)
def candidate_merge(spark, sf_dir):
    items = _t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("r"), F.col("l_suppkey").alias("j"), F.round(F.col("l_quantity") / 50, 4).cast("decimal(5,4)").alias("similarity"), (F.col("l_returnflag") == "R").alias("issn_match"), F.lit(False).alias("publisher_match"), F.when(F.col("l_linestatus") == "O", "fuzzy_title").otherwise("exact_title_ambiguous").alias("match_method"), F.col("l_linenumber").alias("rank_among_candidates"))
    return C.fold(items.withColumn("seq", F.when(F.col("match_method") == "fuzzy_title", 2).otherwise(1)), ("r", "j")).select("r", "j", "similarity", "issn_match", "match_method", "rank_among_candidates")


def _queue(spark, sf_dir):
    """Lines as candidates: a part's suppliers, the cheapest line of each, all pending but for those of some parts."""
    lines = _t(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("source_record_id"), F.col("l_suppkey").alias("candidate_journal_id")).agg(F.max(F.round(F.col("l_quantity") / 50, 4).cast("decimal(5,4)")).alias("similarity"))
    return lines.select(F.lit(2).alias("source_id"), F.lit("part").alias("source_record_table"), "source_record_id", "candidate_journal_id", "similarity", F.lit(1).cast("short").alias("rank_among_candidates"), F.lit("pending").alias("review_status"), F.lit(None).cast("string").alias("reviewed_by"), F.lit(None).cast("timestamp").alias("reviewed_at"))


@_query(
    "WITH q AS (SELECT l_partkey AS r, l_suppkey AS j, max((l_quantity / 50)::DECIMAL(5,4)) AS s FROM lineitem GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY s DESC, j) AS n FROM q) "
    "SELECT r AS source_record_id, j AS candidate_journal_id, CASE WHEN max(CASE WHEN n = 1 THEN s END) OVER (PARTITION BY r) < 0.97 THEN 'pending' WHEN n = 1 THEN 'accepted' ELSE 'rejected' END AS review_status, CASE WHEN n = 1 AND s >= 0.97 THEN 'system_auto' END AS reviewed_by FROM b"
)
def accept_and_close(spark, sf_dir):
    queue = _queue(spark, sf_dir)
    return C.accept_and_close(queue, C.best(queue).where("similarity >= 0.97")).select("source_record_id", "candidate_journal_id", "review_status", "reviewed_by")


@_query(
    "WITH old AS (SELECT o_orderkey AS k, 'old' AS v FROM orders WHERE o_orderkey % 2 = 0), new AS (SELECT l_orderkey AS k, min(l_linenumber) AS n FROM lineitem GROUP BY 1) SELECT k, v FROM old UNION ALL SELECT k, 'line ' || n FROM new WHERE k NOT IN (SELECT k FROM old)"
)
def insert_if_absent(spark, sf_dir):
    old = _t(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("k"), F.lit("old").alias("v"))
    new = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber", F.concat(F.lit("line "), "l_linenumber").alias("v"))
    return state.insert_absent(old, new, ["k"], ["l_linenumber"]).select("k", "v")


@_query("SELECT o_orderkey, CASE WHEN n IS NULL THEN o_orderstatus ELSE 'L' || n END AS o_orderstatus, CASE WHEN n IS NULL THEN 0 ELSE 1 END AS touched FROM orders LEFT JOIN (SELECT l_orderkey, max(l_linenumber) AS n FROM lineitem WHERE l_quantity > 40 GROUP BY 1) ON l_orderkey = o_orderkey")
def update_by_key(spark, sf_dir):
    changes = _t(spark, sf_dir, "lineitem").where("l_quantity > 40").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.concat(F.lit("L"), F.max("l_linenumber")).alias("o_orderstatus"))
    old = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.lit(0).alias("touched"))
    return state.update_by_key(old, changes, ["o_orderkey"], ["o_orderstatus"], F.lit(1), "touched")


@_query("SELECT o_orderkey FROM orders o WHERE o_orderstatus = 'O' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o.o_orderkey)")
def anti_pending(spark, sf_dir):
    return _t(spark, sf_dir, "orders").where("o_orderstatus = 'O'").join(_t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").select("o_orderkey")


@_query("SELECT o_orderkey, 7 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders")
def ordered_ids(spark, sf_dir):
    return state.next_ids(_t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 7).select("o_orderkey", "id")


@_query("SELECT f.n::BIGINT AS n, f.action, count(*)::BIGINT AS files FROM (SELECT s_nationkey % 7 AS n, CASE WHEN row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) > 1 THEN 'skip' WHEN s_nationkey % 7 = 1 THEN 'skip' WHEN s_nationkey % 7 = 2 THEN 'retry' ELSE 'new' END AS action FROM supplier) f GROUP BY ALL")
def dataset_gate(spark, sf_dir):
    from ..operators import ingest

    files = _t(spark, sf_dir, "supplier").select(F.lpad(F.col("s_suppkey").cast("string"), 12, "0").alias("file_path"), F.concat(F.lit("h"), "s_nationkey").alias("sha256"), (F.col("s_nationkey") % 7).cast("long").alias("n"))
    status = F.when(F.col("n_nationkey") % 7 == 1, "loaded").when(F.col("n_nationkey") % 7 == 2, "failed")
    datasets = _t(spark, sf_dir, "nation").select(F.concat(F.lit("h"), "n_nationkey").alias("file_hash"), F.col("n_nationkey").cast("long").alias("id"), status.alias("status")).where("status is not null")
    return ingest.gate(files, datasets).groupBy("n", "action").agg(F.count("*").alias("files"))


@_query()
def resolve_ladder(spark, sf_dir):
    """All parts resolved onto the first title of each name, with journals made on the way; compared with a sequential version in tests."""
    parts = _t(spark, sf_dir, "part").withColumn("title", F.concat_ws(" ", "p_name", F.lower("p_type")))
    journals = parts.groupBy("p_name").agg(F.min("p_partkey").alias("id"), F.min("title").alias("normalized_title")).select("id", "normalized_title")
    identifiers = journals.select(F.col("id").alias("journal_id"), F.lit("ISSN").alias("identifier_type"), F.concat(F.lit("s"), "id").alias("normalized_value"))
    records = parts.select(F.col("p_partkey").alias("id"), F.col("title").alias("key"), F.when(F.col("p_partkey") % 11 == 0, F.array(F.concat(F.lit("s"), F.col("p_partkey") % 97))).otherwise(F.array().cast("array<string>")).alias("issns"))
    return resolve.resolve_records(records, journals, identifiers, 1_000_000_000).outcomes


# --- canonical seed and review ------------------------------------------------------------------------------------------


def _seeded(spark, sf_dir):
    """Parts as yearly records of their brand, seeded into a canonical dimension."""
    from .. import schemas
    from ..operators import canonical

    parts = _t(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("sourceid"), (F.col("p_size") + 1990).alias("year"), F.col("p_type").alias("subject_area"), F.col("p_name").alias("title"),
        F.concat(F.lpad((F.col("p_partkey") % 600).cast("string"), 4, "0"), F.lit("-0000, bad")).alias("issn_raw"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("House "), "p_type")).alias("publisher_raw"),
    )
    return canonical.seed(schemas.conform(parts, "scimago_records"))


@_query(
    "WITH r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey % 2, lower(p_type), p_type, p_partkey) AS n, min(p_size) OVER (PARTITION BY p_brand) AS first FROM part) "
    "SELECT row_number() OVER (ORDER BY p_brand) AS id, p_name AS canonical_title, CASE WHEN p_partkey % 2 = 0 THEN 'House ' || p_type END AS publisher, (first + 1990)::INT AS first_observed_year FROM r WHERE n = 1"
)
def canonical_journals(spark, sf_dir):
    return _seeded(spark, sf_dir)["journals"].select("id", "canonical_title", "publisher", "first_observed_year")


@_query(
    "WITH ids AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) AS id FROM (SELECT DISTINCT p_brand FROM part)), "
    "owners AS (SELECT lpad((p_partkey % 600)::VARCHAR, 4, '0') || '0000' AS v, min(p_brand) AS p_brand FROM part GROUP BY 1) "
    "SELECT id AS journal_id, 'ISSN' AS identifier_type, v AS normalized_value FROM owners JOIN ids USING (p_brand) UNION ALL SELECT id, 'SCIMAGO_SOURCE_ID', p_brand FROM ids"
)
def canonical_identifiers(spark, sf_dir):
    return _seeded(spark, sf_dir)["journal_identifiers"].select("journal_id", "identifier_type", "normalized_value")


_DECISION = "CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'rejected_no_match' ELSE 'new_journal' END"


@_query(
    f"SELECT l_partkey AS source_record_id, count(DISTINCT {_DECISION})::BIGINT AS decisions, count(DISTINCT l_suppkey)::BIGINT AS candidates, bool_or(l_returnflag = 'A') AS accepts FROM lineitem GROUP BY 1 HAVING count(DISTINCT {_DECISION}) > 1 OR (bool_or(l_returnflag = 'A') AND count(DISTINCT l_suppkey) <> 1)"
)
def review_conflicts(spark, sf_dir):
    from ..operators import review

    decided = _t(spark, sf_dir, "lineitem").select(F.lit("ABDC").alias("source"), F.col("l_partkey").alias("source_record_id"), F.col("l_suppkey").alias("candidate_id"), F.expr(_DECISION).alias("csv_decision"))
    return review.group_conflicts(decided).select("source_record_id", "decisions", "candidates", "accepts")


@_query(
    "SELECT event_id AS candidate_id, array_to_string(list_filter([CASE WHEN event_id = 0 THEN 'invalid_candidate_id' END, CASE WHEN user_id % 7 = 0 THEN 'invalid_source' END, CASE WHEN user_id = 0 THEN 'invalid_source_record_id' END, CASE WHEN event_type NOT IN ('click', 'view') THEN 'invalid_decision' END], lambda x: x IS NOT NULL), ',') AS problems FROM events WHERE event_type <> 'error'"
)
def review_rows(spark, sf_dir):
    from ..operators import review

    decision = F.when(F.col("event_type") == "click", " Accepted").when(F.col("event_type") == "view", "NEW_JOURNAL").when(F.col("event_type") == "error", "  ").otherwise(F.col("event_type"))
    rows = _t(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("candidate_id"), F.when(F.col("user_id") % 7 == 0, "SCIMAGO").otherwise("abs ").alias("source"), F.concat("user_id", F.lit(".0")).alias("source_record_id"), F.lit("5").alias("candidate_journal_id"), decision.alias("decision"), "event_id"
    )
    checked = review.check_rows(rows)
    return checked.select(F.col("event_id").alias("candidate_id"), F.array_join("problems", ",").alias("problems"))


from . import demo_flow  # noqa: E402, F401  its queries register themselves
