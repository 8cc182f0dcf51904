"""Raw rows to normalized records: one projection a source, with the row's problems beside it."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalars as S
from ..sources import delimited, workbook

_AJG = re.compile(r"^AJG(\d{4})$")


def raw_columns(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if not c.startswith("_")]


_KEPT = ("_file", "_row_number", "raw_json")


def _cells(rows: DataFrame, cells: dict[str, tuple[str, ...]], **more: Column) -> DataFrame:
    """The row's file, number and JSON, and each cell under a name of its own: cleaned, the first that isn't empty.

    Later steps take cells from these columns, so no cleaning is done twice.
    """
    return rows.select("_file", "_row_number", S.row_json(raw_columns(rows)).alias("raw_json"), *[S.first_non_empty(names, rows.columns).alias(f"c_{c}") for c, names in cells.items()], *[x.alias(c) for c, x in more.items()])


def _kept() -> list[Column]:
    return [*map(F.col, _KEPT), F.sha2(F.col("raw_json").cast("binary"), 256).alias("source_row_hash")]


def problems(checks: dict[str, Column]) -> Column:
    """The names of the checks that hold, in order."""
    return F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(True)), F.lit(name)) for name, test in checks.items()])).alias("problems")


def _int(value: Column) -> Column:
    return S.parse_int(value).try_cast("int")


def transform_scimago(rows: DataFrame) -> DataFrame:
    """Wide rows to records with arrays of categories, areas and identifiers; year and area come from the file's name.

    The column of documents in the year carries the year in its name, so each file's own column is picked by its year.
    """
    name = delimited.parse_file_name(F.col("_file"))
    years = {c: int(m[1]) for c in rows.columns if (m := re.match(r"^Total Docs\. \((\d{4})\)$", c))}
    total = F.coalesce(*[F.when(name["year"] == y, F.col(f"`{c}`")) for c, y in years.items()], F.lit(None).cast("string"))
    # The source's column names by record column.
    named = {
        "rank": "Rank", "sourceid": "Sourceid", "title": "Title", "type": "Type", "issn_raw": "Issn", "publisher_raw": "Publisher", "open_access": "Open Access", "open_access_diamond": "Open Access Diamond", "sjr": "SJR", "sjr_best_quartile": "SJR Best Quartile", "h_index": "H index",
        "total_docs_3years": "Total Docs. (3years)", "total_refs": "Total Refs.|Total Refs", "total_citations_3years": "Total Citations (3years)|Total Cites (3years)", "citable_docs_3years": "Citable Docs. (3years)", "citations_per_doc_2years": "Citations / Doc. (2years)",
        "refs_per_doc": "Ref. / Doc.", "female_percentage": "%Female", "overton": "Overton", "country": "Country", "region": "Region", "coverage": "Coverage", "categories": "Categories", "areas": "Areas",
    }
    cells = _cells(rows, {k: tuple(v.split("|")) for k, v in named.items()}, year=name["year"], subject_area=name["subject_area"], c_total_docs=total)
    text = ("sourceid", "title", "type", "issn_raw", "publisher_raw", "country", "region", "coverage")
    whole = ("rank", "h_index", "total_docs", "total_docs_3years", "total_refs", "total_citations_3years", "citable_docs_3years", "overton")
    decimals = {"citations_per_doc_2years": "decimal(10,3)", "refs_per_doc": "decimal(10,3)", "female_percentage": "decimal(6,3)"}
    out = cells.select(
        *_kept(), "year", "subject_area", *[F.col(f"c_{c}").alias(c) for c in text], *[_int(F.col(f"c_{c}")).alias(c) for c in whole], *[S.parse_decimal_comma(f"c_{c}").try_cast(kind).alias(c) for c, kind in decimals.items()],
        S.split_multi_issn("c_issn_raw").alias("issn_list"), S.yes("c_open_access").alias("open_access"), S.yes("c_open_access_diamond").alias("open_access_diamond"), S.parse_decimal_comma("c_sjr").alias("sjr_value"), S.quartile("c_sjr_best_quartile").alias("sjr_best_quartile"),
        S.parse_categories("c_categories").alias("categories"), S.parse_areas("c_areas").alias("areas"),
    )
    return out.withColumns({"sjr": F.col("sjr_value").try_cast("decimal(10,3)"), "sjr_out_of_range": F.col("sjr_value").isNotNull() & ~S.in_range("sjr_value", 0, 100)})


def validate_scimago(records: DataFrame) -> DataFrame:
    """Problems in a fixed order; a row that's out of range only says so, as its other values can't be trusted."""
    every = problems(
        {
            "sourceid_missing": F.col("sourceid").isNull(),
            "title_missing": F.col("title").isNull(),
            "sjr_out_of_range": F.col("sjr_value").isNotNull() & ~S.in_range("sjr_value", 0, 100),
            "invalid_sjr_best_quartile": F.col("sjr_best_quartile").isNotNull() & ~F.col("sjr_best_quartile").isin(*schemas.QUARTILES),
        }
    )
    return records.withColumn("problems", F.when(F.col("sjr_out_of_range"), F.array(F.lit("sjr_out_of_range"))).otherwise(every))


def transform_abdc(rows: DataFrame, sheet: str) -> DataFrame:
    """A sheet's rows to records; year, scheme and rating column follow from the sheet. A rating that isn't known is null."""
    if sheet not in workbook.SHEETS:
        raise ValueError(f"unknown sheet {sheet!r}")
    year, scheme, rating = workbook.SHEETS[sheet]
    column = workbook.find_column(raw_columns(rows), rating)
    cells = _cells(rows, {"name": workbook.TITLE_NAMES, "publisher": ("Publisher",), "issn": ("ISSN",), "issn_online": ("ISSN Online", "ISSNOnline"), "inception": ("Year Inception", "Start year"), "for_code": ("FoR", "ABDC FoR code", "Field of Research"), "rating": (column,)})
    return cells.select(
        *_kept(), F.lit(year).alias("rating_year"), F.col("c_name").alias("journal_name"), F.col("c_publisher").alias("publisher"), S.normalize_issn("c_issn").alias("issn"), S.normalize_issn("c_issn_online").alias("issn_online"),
        S.parse_year("c_inception").alias("year_inception"), F.col("c_for_code").alias("for_code"), F.lit(scheme).alias("for_scheme"), S.abdc_rating("c_rating").alias("rating"),
    )


_HASH = "^[0-9a-fA-F]{64}$"


def validate_abdc(records: DataFrame) -> DataFrame:
    years, schemes = sorted({y for y, _, _ in workbook.SHEETS.values()}), sorted({s for _, s, _ in workbook.SHEETS.values()})
    return records.withColumn(
        "problems",
        problems(
            {
                "journal_name_missing": S.is_missing("journal_name"),
                "invalid_source_row_hash": ~F.col("source_row_hash").rlike(_HASH),
                "invalid_rating_year": ~F.col("rating_year").isin(*years),
                "invalid_for_scheme": ~F.col("for_scheme").isin(*schemes),
                "invalid_rating": F.col("rating").isNotNull() & ~F.col("rating").isin(*schemas.ABDC_RATINGS),
            }
        ),
    )


def unpivot_abs(rows: DataFrame) -> DataFrame:
    """One record for each row and AJGYYYY column with a rating; the hash is of the wide row. No such column is an error."""
    ratings = [c for c in rows.columns if _AJG.match(c)]
    if not ratings:
        raise ValueError("there is no AJG rating column")
    cells = _cells(rows, {"name": ("TITLE",), "field": ("FIELD",), "issn": ("ISSN",), "publisher": ("PUBLISHER",)}, **{c: F.col(c).cast("string") for c in ratings})
    base = cells.select(*_kept(), F.col("c_name").alias("journal_name"), F.col("c_field").alias("field"), S.normalize_issn("c_issn").alias("issn"), F.col("c_publisher").alias("publisher"), *ratings)
    fixed = [c for c in base.columns if c not in ratings]
    long = base.unpivot(fixed, ratings, "rating_column", "rating").withColumn("rating", S.or_null(S.clean_whitespace("rating")))
    return long.where("rating is not null").withColumn("rating_year", F.regexp_extract("rating_column", "([0-9]{4})$", 1).cast("int")).drop("rating_column")


def validate_abs(records: DataFrame) -> DataFrame:
    return records.withColumn(
        "problems",
        problems(
            {
                "journal_name_missing": S.is_missing("journal_name"),
                "invalid_rating_year": ~S.in_range("rating_year", 1000, 9999),
                "invalid_rating": ~F.col("rating").isin(*schemas.ABS_RATINGS),
                "invalid_source_row_hash": ~F.col("source_row_hash").rlike(_HASH),
            }
        ),
    )


def transform_repec(rows: DataFrame) -> DataFrame:
    """A number that can't be read is null and makes the row invalid; it doesn't stop the file."""
    cells = _cells(rows, {"rank": ("rank",), "name": ("journals",), "items": ("items_listed",), "h": ("h_index",)} | {c: (c,) for c in REPEC_DECIMALS})
    parsed = cells.select(
        *_kept(), F.lit(None).cast("date").alias("source_snapshot_date"), _int(F.col("c_rank")).alias("rank"), F.col("c_name").alias("journal_name_raw"), S.split_publisher("c_name").alias("split"), _int(F.col("c_items")).alias("items_listed"), _int(F.col("c_h")).alias("h_index"),
        *[S.parse_decimal_comma(f"c_{c}").try_cast("decimal(10,3)").alias(c) for c in REPEC_DECIMALS], F.array(*[F.col(f"c_{c}").isNotNull() for c in REPEC_DECIMALS]).alias("given"),
    )
    found = F.array(*[F.col(c).isNotNull() for c in REPEC_DECIMALS])
    names = {"journal_name_clean": S.or_null("split.name"), "publisher_from_name": F.col("split.publisher"), "publisher_split_confidence": F.col("split.confidence"), "bad_number": F.col("given") != found}
    return parsed.withColumns(names).drop("split", "given")


REPEC_DECIMALS = ("score", "simple_if", "recursive_if", "discounted_if", "recursive_discounted_if", "euclid")


def validate_repec(records: DataFrame) -> DataFrame:
    return records.withColumn(
        "problems",
        problems(
            {
                "journal_name_raw_missing": S.is_missing("journal_name_raw"),
                "journal_name_clean_missing": S.is_missing("journal_name_clean"),
                "invalid_publisher_split_confidence": ~F.col("publisher_split_confidence").isin("high", "low", "none"),
                "invalid_source_row_hash": ~F.col("source_row_hash").rlike(_HASH),
                "invalid_rank": F.col("rank").isNotNull() & (F.col("rank") < 1),
                "invalid_number": F.col("bad_number"),
            }
        ),
    ).drop("bad_number")


def transform_ft50(rows: DataFrame) -> DataFrame:
    delimited.require_columns(rows, delimited.FT50_COLUMNS)
    cells = _cells(rows, {"year": ("ft50_year",), "rank": ("rank",), "name": ("journal_name",)})
    return cells.select(*_kept(), S.parse_year("c_year").alias("ft50_year"), _int(F.col("c_rank")).alias("rank"), F.col("c_name").alias("journal_name"), F.lit(True).alias("included"))


def validate_ft50(records: DataFrame) -> DataFrame:
    return records.withColumn(
        "problems",
        problems(
            {
                "journal_name_missing": S.is_missing("journal_name"),
                "invalid_ft50_year": F.col("ft50_year").isNull(),
                "invalid_rank": F.col("rank").isNull() | (F.col("rank") < 1),
                "invalid_source_row_hash": ~F.col("source_row_hash").rlike(_HASH),
            }
        ),
    )


TRANSFORMS = {
    "SCIMAGO": lambda rows, sheet=None: validate_scimago(transform_scimago(rows)),
    "ABDC": lambda rows, sheet=None: validate_abdc(transform_abdc(rows, sheet)),
    "ABS": lambda rows, sheet=None: validate_abs(unpivot_abs(rows)),
    "REPEC": lambda rows, sheet=None: validate_repec(transform_repec(rows)),
    "FT50": lambda rows, sheet=None: validate_ft50(transform_ft50(rows)),
}
#: What tells a record from its repeats within a dataset.
RECORD_KEYS = {"SCIMAGO": ("sourceid", "year", "subject_area"), "ABDC": ("source_row_hash", "rating_year"), "ABS": ("source_row_hash", "rating_year"), "REPEC": ("source_row_hash",), "FT50": ("source_row_hash", "ft50_year")}
