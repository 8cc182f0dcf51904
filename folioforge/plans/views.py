"""The four served views, as functions from tables to DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in an order that leaves no ties; rows with a null first key are left out."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.where(F.col(key[0]).isNotNull()).withColumn("_place", place).where("_place = 1").drop("_place")


# How the current row of a key is told, for the views of one row a journal (and area).
SCIMAGO_KEY, SCIMAGO_ORDER = ["journal_id", "subject_area"], [F.desc_nulls_first, "year", F.desc_nulls_last, "sjr", F.desc, "id"]
ABDC_KEY, ABDC_ORDER = ["journal_id"], [F.desc_nulls_first, "rating_year", F.desc_nulls_first, "dataset_id", F.desc, "id"]


def _ordered(order: list) -> list[Column]:
    return [way(column) for way, column in zip(order[::2], order[1::2], strict=True)]


def current(records: DataFrame, source: str) -> DataFrame:
    """The current record of each journal (SCIMAGO: and area), with all its columns, so that more records can be merged into it."""
    key, order = (SCIMAGO_KEY, SCIMAGO_ORDER) if source == "SCIMAGO" else (ABDC_KEY, ABDC_ORDER)
    return latest(records, key, _ordered(order))


def merged_current(state: DataFrame, source: str, added: DataFrame, gone: DataFrame | None = None, left: DataFrame | None = None) -> DataFrame:
    """current() of all records, from current() of the older ones and those added.

    Of the older records none is read, unless some are gone: then left, the records that are left, is read for the
    journals that the gone ones had, and for no other.
    """
    if gone is None:
        return current(state.unionByName(added.select(*state.columns)), source)
    if left is None:
        raise ValueError("the records that are left are needed to replace those that are gone")
    touched = gone.where("journal_id is not null").select("journal_id").distinct()
    kept = state.join(touched, "journal_id", "left_anti").select(*state.columns)
    anew = left.join(touched, "journal_id", "left_semi").select(*state.columns)
    return current(kept.unionByName(anew).unionByName(added.select(*state.columns)), source)


def scimago_latest(records: DataFrame) -> DataFrame:
    return current(records, "SCIMAGO").select("journal_id", "subject_area", "year", "sjr", "sjr_best_quartile", "h_index", F.col("id").alias("scimago_record_id"))


def abdc_latest(records: DataFrame) -> DataFrame:
    return current(records, "ABDC").select("journal_id", "rating_year", "rating", "for_code", "for_scheme", "dataset_id")


def flags(base: DataFrame, key: str, present: dict[str, DataFrame]) -> DataFrame:
    """base with one flag for each named set of keys: whether its key is in the set."""
    for name, keys in present.items():
        there = keys.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_there", F.lit(True))
        base = base.join(there, key, "left").withColumn(name, F.col("_there").isNotNull()).drop("_there")
    return base


def source_availability(journals: DataFrame, scimago: DataFrame, abdc: DataFrame, abs_: DataFrame, repec: DataFrame, ft50: DataFrame) -> DataFrame:
    base = journals.select(F.col("id").alias("journal_id"), "canonical_title")
    return flags(base, "journal_id", {"has_scimago": scimago, "has_abdc": abdc, "has_abs": abs_, "has_repec": repec, "has_ft50": ft50})


def quartile_rank(quartile: Column | str) -> Column:
    value = F.col(quartile) if isinstance(quartile, str) else quartile
    return F.when(value == "Q1", 1).when(value == "Q2", 2).when(value == "Q3", 3).when(value == "Q4", 4).otherwise(5)


def journal_summary(journals: DataFrame, scimago: DataFrame, abdc: DataFrame, ft50: DataFrame) -> DataFrame:
    """Each journal with its best current SCImago area, its current ABDC rating, and whether it's in the FT50."""
    best = latest(scimago_latest(scimago), ["journal_id"], [quartile_rank("sjr_best_quartile"), F.desc_nulls_last("sjr"), F.asc("subject_area")])
    best = best.select("journal_id", F.col("sjr").alias("scimago_current_sjr"), F.col("sjr_best_quartile").alias("scimago_current_quartile"))
    rated = abdc_latest(abdc).select("journal_id", F.col("rating").alias("abdc_current_rating"))
    base = journals.select(F.col("id").alias("journal_id"), "canonical_title", "publisher")
    return flags(base.join(best, "journal_id", "left").join(rated, "journal_id", "left"), "journal_id", {"in_ft50": ft50})


def register(store) -> None:
    """The views as temporary SQL views under the names they're served by."""
    r = store.read
    scimago, abdc, abs_, repec, ft50 = (r(t) for t in ("scimago_records", "abdc_records", "abs_records", "repec_records", "ft50_records"))
    scimago_latest(scimago).createOrReplaceTempView("journal_scimago_latest_view")
    abdc_latest(abdc).createOrReplaceTempView("journal_abdc_latest_view")
    source_availability(r("journals"), scimago, abdc, abs_, repec, ft50).createOrReplaceTempView("journal_source_availability_view")
    journal_summary(r("journals"), scimago, abdc, ft50).createOrReplaceTempView("journal_summary_view")
