"""Schemas of the engine's tables, as DDL, with their keys and value domains."""

from __future__ import annotations

import functools
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    ddl: str
    keys: tuple[tuple[str, ...], ...] = ()
    domains: dict[str, tuple] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)
    required: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)


# The five sources and their ids.
SOURCES = ((1, "SCIMAGO", "SCImago Journal Rank"), (2, "ABDC", "ABDC Journal Quality List"), (3, "ABS", "Academic Journal Guide (ABS/AJG)"), (4, "REPEC", "RePEc Aggregate Rankings"), (5, "FT50", "Financial Times 50"))
SOURCE_IDS = {code: k for k, code, _ in SOURCES}
RECORD_TABLES = {"SCIMAGO": "scimago_records", "ABDC": "abdc_records", "ABS": "abs_records", "REPEC": "repec_records", "FT50": "ft50_records"}
# The domains of ratings, statuses and decisions.
QUARTILES, ABDC_RATINGS, ABS_RATINGS = ("Q1", "Q2", "Q3", "Q4"), ("A*", "A", "B", "C"), ("1", "2", "3", "4", "4*")
REVIEW_STATUSES = ("pending", "accepted", "rejected")
DECISIONS = ("accepted", "manually_confirmed", "rejected_no_match", "new_journal")
IDENTIFIER_TYPES = ("ISSN", "EISSN", "SCIMAGO_SOURCE_ID")
DATASET_STATUSES = ("pending", "loaded", "failed")

_RECORD = "id long, journal_id long, dataset_id long, raw_row_id long"
_HASHED = f"{_RECORD}, source_row_hash string"
_REFERENCE = "source_id int, source_record_table string, source_record_id long"
_REFERENCE_KEY = ("source_id", "source_record_table", "source_record_id")

# The tables with their columns, keys and value domains, in the order of their dependence.
TABLES: dict[str, Table] = {
    "sources": Table("id int, code string, display_name string", (("id",), ("code",))),
    "datasets": Table("id long, source_id int, dataset_year int, subject_area string, file_name string, file_hash string, imported_at timestamp, record_count long, status string", (("id",), ("file_hash",)), {"status": DATASET_STATUSES}, {"subject_area": 150, "file_name": 255}),
    "raw_files": Table("id long, dataset_id long, file_path string, sha256 string, file_size long, parser_version string, created_at timestamp", (("id",), ("sha256",)), lengths={"file_path": 500}),
    "raw_rows": Table("id long, raw_file_id long, row_number long, raw_data string", (("id",), ("raw_file_id", "row_number"))),
    "ingestion_rejections": Table("id long, dataset_id long, raw_file_id long, row_number long, reason string, details string, raw_row_snapshot string, created_at timestamp", lengths={"reason": 100}),
    "journals": Table("id long, canonical_title string, normalized_title string, publisher string, first_observed_year int, created_at timestamp, updated_at timestamp", (("id",),), required=("canonical_title", "normalized_title")),
    "journal_identifiers": Table("id long, journal_id long, identifier_type string, identifier_value string, normalized_value string, source_id int, is_primary boolean", (("identifier_type", "normalized_value"),), {"identifier_type": IDENTIFIER_TYPES}),
    "journal_aliases": Table("id long, journal_id long, source_id int, alias_name string, normalized_alias string", (("journal_id", "normalized_alias"),)),
    "journal_source_mapping": Table(f"id long, journal_id long, {_REFERENCE}, match_method string, match_score decimal(4,3), match_status string", (_REFERENCE_KEY,)),
    "scimago_records": Table(
        f"{_RECORD}, year int, subject_area string, rank int, sourceid string, title string, type string, issn_raw string, publisher_raw string, open_access boolean, open_access_diamond boolean, "
        "sjr decimal(10,3), sjr_best_quartile string, h_index int, total_docs int, total_docs_3years int, total_refs int, total_citations_3years int, citable_docs_3years int, citations_per_doc_2years decimal(10,3), refs_per_doc decimal(10,3), "
        "female_percentage decimal(6,3), overton int, country string, region string, coverage string, raw_json string",
        (("id",), ("sourceid", "year", "subject_area", "dataset_id")), {"sjr_best_quartile": QUARTILES}, {"title": 500}, ("sourceid", "title"),
    ),
    "scimago_categories": Table("id long, scimago_record_id long, category_name string, quartile string"),
    "scimago_areas": Table("id long, scimago_record_id long, area_name string"),
    "abdc_records": Table(f"{_HASHED}, rating_year int, journal_name string, publisher string, issn string, issn_online string, year_inception int, for_code string, for_scheme string, rating string, raw_json string", (("id",), ("dataset_id", "source_row_hash", "rating_year")), {"rating": ABDC_RATINGS}),
    "abs_records": Table(f"{_HASHED}, rating_year int, journal_name string, field string, issn string, publisher string, rating string, raw_json string", (("id",), ("dataset_id", "source_row_hash", "rating_year")), {"rating": ABS_RATINGS}, required=("rating",)),
    "repec_records": Table(
        f"{_HASHED}, source_snapshot_date date, imported_at timestamp, rank int, journal_name_raw string, journal_name_clean string, publisher_from_name string, publisher_split_confidence string, score decimal(10,3), items_listed int, "
        "simple_if decimal(10,3), recursive_if decimal(10,3), discounted_if decimal(10,3), recursive_discounted_if decimal(10,3), h_index int, euclid decimal(10,3), raw_json string",
        (("id",), ("dataset_id", "source_row_hash")),
    ),
    "ft50_records": Table(f"{_HASHED}, ft50_year int, rank int, journal_name string, included boolean, raw_json string", (("id",), ("dataset_id", "source_row_hash", "ft50_year"))),
    "entity_match_candidates": Table(
        f"id long, {_REFERENCE}, candidate_journal_id long, similarity decimal(5,4), issn_match boolean, publisher_match boolean, match_method string, rank_among_candidates short, review_status string, reviewed_by string, reviewed_at timestamp, created_at timestamp",
        (("id",), (*_REFERENCE_KEY, "candidate_journal_id")), {"review_status": REVIEW_STATUSES},
    ),
    "identifier_conflicts": Table("identifier string, journal_ids array<long>, source_id int, source_record_table string", (("identifier", "source_record_table"),), required=("identifier",)),
    "resolution_failures": Table(f"{_REFERENCE}, reason string, created_at timestamp", (_REFERENCE_KEY,), required=("reason",)),
    "entity_match_decisions": Table(f"id long, {_REFERENCE}, journal_id long, match_method string, confidence decimal(5,4), decision string, reviewed_by string, reviewed_at timestamp", (_REFERENCE_KEY,), {"decision": DECISIONS}),
}


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name].schema)


def sources(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SOURCES), TABLES["sources"].schema)


def conform(df: DataFrame, name: str) -> DataFrame:
    """The columns of a table in their order and types; columns that df lacks are null, columns beyond them go."""
    has = {c.lower() for c in df.columns}
    return df.select(*[(F.col(f.name) if f.name.lower() in has else F.lit(None)).cast(f.dataType).alias(f.name) for f in TABLES[name].schema])


def _row_checks(table: Table) -> list[tuple[str, Column, str]]:
    """(constraint, what breaks it, column) of the rules that a row breaks by itself."""
    checks = [(f"domain({c})", F.col(c).isNotNull() & ~F.col(c).isin(*values), c) for c, values in table.domains.items()]
    checks += [(f"length({c})", F.coalesce(F.length(c) > n, F.lit(False)), c) for c, n in table.lengths.items()]
    return checks + [(f"required({c})", F.col(c).isNull(), c) for c in table.required]


def unsound(name: str, columns) -> Column:
    """Whether a row breaks a rule of its table by itself; of the columns that there are."""
    out = F.lit(False)
    for _, test, column in _row_checks(TABLES[name]):
        if column in columns:
            out = out | test
    return out


#: Rows of which there may be one for each value of some columns: (constraint, which rows, columns).
ONE_OF = {
    "entity_match_candidates": ("one accepted candidate a record", "review_status = 'accepted'", _REFERENCE_KEY),
    "journal_identifiers": ("one primary identifier a type", "is_primary", ("journal_id", "identifier_type")),
}


def row_violations(df: DataFrame, name: str) -> DataFrame:
    """(constraint, detail, n) of the domains, lengths and required columns that rows break by themselves, from one scan."""
    told = [F.when(test, F.struct(F.lit(label).alias("constraint"), F.col(column).cast("string").alias("detail"))) for label, test, column in _row_checks(TABLES[name])]
    if not told:
        return _nothing(df)
    each = df.select(F.explode(F.array_compact(F.array(*told))).alias("x")).select("x.constraint", "x.detail")
    return each.groupBy("constraint", "detail").agg(F.count("*").alias("n"))


def key_violations(df: DataFrame, name: str) -> DataFrame:
    """(constraint, detail, n) of the keys that several rows have, all keys of a table in one scan and one aggregation."""
    keys = [(f"unique({', '.join(key)})", functools.reduce(Column.__and__, [F.col(c).isNotNull() for c in key]), key) for key in TABLES[name].keys]
    if name in ONE_OF:
        label, rows, key = ONE_OF[name]
        keys.append((label, F.expr(rows), key))
    if not keys:
        return _nothing(df)
    each = F.array_compact(F.array(*[F.when(rows, F.struct(F.lit(k).alias("key"), F.array(*[F.col(c).cast("string") for c in key]).alias("values"))) for k, (_, rows, key) in enumerate(keys)]))
    several = df.select(F.explode(each).alias("x")).groupBy("x.key", "x.values").agg(F.count("*").alias("n")).where("n > 1")
    types = {f.name: f.dataType for f in TABLES[name].schema}
    chosen = lambda made: functools.reduce(lambda out, k: out.when(F.col("key") == k, made(*keys[k])), range(1, len(keys)), F.when(F.col("key") == 0, made(*keys[0])))
    detail = chosen(lambda _, __, key: F.to_json(F.struct(*[F.col("values")[i].cast(types[c]).alias(c) for i, c in enumerate(key)])))
    return several.select(chosen(lambda label, *_: F.lit(label)).alias("constraint"), detail.alias("detail"), "n")


def _nothing(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], "constraint string, detail string, n long")


def violations(df: DataFrame, name: str) -> DataFrame:
    """(constraint, detail, n) of what breaks a table's keys, domains, lengths or required columns; empty if it is sound."""
    return row_violations(df, name).unionByName(key_violations(df, name))
