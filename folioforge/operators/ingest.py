"""From files to record tables: a gate by content hash, raw rows, records or rejections, and a dataset's status."""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalars as S
from ..sources import delimited, workbook
from . import state
from .transforms import RECORD_KEYS, TRANSFORMS, raw_columns

PARSER_VERSION = "1.0"
# The years that datasets without one in their name stand for.
DATASET_YEARS = {"ABDC": 2025, "ABS": 2024, "REPEC": None, "FT50": 2026}
DEPENDENTS = ("scimago_categories", "scimago_areas")


def file_facts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file_path, file_name, sha256, file_size) of each file."""
    return delimited.digests(spark, paths).select("file_path", F.element_at(F.split("file_path", "/"), -1).alias("file_name"), "sha256", F.col("size").alias("file_size"))


def gate(facts: DataFrame, datasets: DataFrame) -> DataFrame:
    """facts with what to do: skip a loaded file, retry one that failed or is pending, and load a new one; of equal files the first by path."""
    known = datasets.select(F.col("file_hash").alias("sha256"), F.col("id").alias("dataset_id"), "status")
    first = F.row_number().over(Window.partitionBy("sha256").orderBy("file_path"))
    return facts.join(known, "sha256", "left").withColumn("action", F.when(first > 1, "skip").when(F.col("status") == "loaded", "skip").when(F.col("status").isNotNull(), "retry").otherwise("new"))


def split_records(records: DataFrame, source: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid, rejections, repeats): the first row of each key, one rejection a problem, and the rows that repeat a key."""
    good = records.where(F.size("problems") == 0).withColumn("_key", F.struct("_file", *RECORD_KEYS[source]))
    first = good.groupBy("_key").agg(F.min("_row_number").alias("_first"))
    placed = state.join_one(good, first, "_key")
    # Rows that share a number and a key are alike; one of them is the first.
    at_first = placed.where("_row_number = _first").withColumn("_place", F.row_number().over(Window.partitionBy("_key").orderBy("_row_number"))).drop("_key", "_first", "problems")
    later = placed.where("_row_number > _first").select("_file", "_row_number")
    reasons = records.where(F.size("problems") > 0).select("_file", "_row_number", "raw_json", F.explode("problems").alias("reason"))
    rejections = reasons.select("_file", F.col("_row_number").alias("row_number"), F.substring("reason", 1, 100).alias("reason"), F.lit(None).cast("string").alias("details"), F.col("raw_json").alias("raw_row_snapshot"))
    return at_first.where("_place = 1").drop("_place"), rejections, later.unionByName(at_first.where("_place > 1").select("_file", "_row_number"))


def read_source(spark: SparkSession, source: str, paths: list[str]) -> list[tuple[DataFrame, str | None, dict[str, str]]]:
    """Raw rows of files, the sheet they're from, and each file's path by what its rows call it.

    Delimited files come in as many parts as they have layouts, however many they are; a workbook in one a sheet, its row
    numbers running on from sheet to sheet.
    """
    if source != "ABDC":
        found = delimited.layouts(spark, paths, delimited.SOURCE_DELIMITERS[source])
        return [(delimited.read_layout(spark, layout, [p for p, _ in files]), None, {uri: p for p, uri in files}) for layout, files in found.items()]
    out = []
    for path in paths:
        book, first = workbook.sheets(workbook.content_of(spark, path)), 1
        for sheet in workbook.SHEETS:
            df = workbook.abdc_sheet(spark, book, sheet, path, first)
            first += df.count()
            out.append((df, sheet, {path: path}))
    return out


@dataclass
class _Batch:
    """Rows of files on their way to the tables, keyed by (_file, _row_number); files that can't be read with the reason."""

    raw: DataFrame | None = None
    valid: DataFrame | None = None
    rejected: DataFrame | None = None
    names: dict[str, str] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)


def _gather(spark: SparkSession, source: str, paths: list[str]) -> _Batch:
    """Files whose columns a source doesn't have, or whose records break their table's rules, fail by themselves."""
    out, table = _Batch(), schemas.RECORD_TABLES[source]
    try:
        parts = read_source(spark, source, paths)
    except Exception as error:  # noqa: BLE001  read one by one, the others can be told from those that can't be read
        if len(paths) == 1:
            return _Batch(failed={paths[0]: str(error)})
        parts = []
        for path in paths:
            try:
                parts += read_source(spark, source, [path])
            except Exception as own:  # noqa: BLE001
                out.failed[path] = str(own)
    for rows, sheet, names in parts:
        try:
            if source == "FT50":
                delimited.require_ft50(rows)
            records = state.durable(TRANSFORMS[source](rows, sheet))  # parsed once; what follows plans from here
            good, bad, _ = split_records(records, source)
            lines = records.select("_file", "_row_number", "raw_json").distinct() if source != "ABS" else rows.select("_file", "_row_number", S.row_json(raw_columns(rows)).alias("raw_json"))
        except ValueError as error:
            out.failed.update(dict.fromkeys(names.values(), str(error)))
            continue
        out.names.update(names)
        out.raw, out.valid, out.rejected = (new if old is None else old.unionByName(new, allowMissingColumns=True) for old, new in ((out.raw, lines), (out.valid, good), (out.rejected, bad)))
    out.failed.update(dict.fromkeys(set(paths) - set(out.names.values()) - set(out.failed), "no line"))
    if out.valid is not None:
        out.raw, out.valid, out.rejected = map(state.durable, (out.raw, out.valid, out.rejected))
        has = {c.lower() for c in out.valid.columns}
        typed = out.valid.select("_file", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.TABLES[table].schema if f.name.lower() in has])
        for r in typed.where(schemas.unsound(table, typed.columns)).groupBy("_file").agg(F.count("*").alias("n")).collect():  # one row a file
            out.failed[out.names[r._file]] = f"{r.n} records break their table's rules"
    return out


def import_files(store: state.Store, source: str, paths: list[str], now: datetime.datetime | None = None) -> dict[str, str]:
    """Load files in one go: 'loaded', 'skipped', or 'failed: ' and the reason, by path.

    All files are gated, read, checked and numbered together and published as one version; a file that fails keeps
    none of the others from being loaded, and its dataset is marked. Ids go by the files' paths and the rows' places. A
    file's name has to tell year and subject area for the source that splits its files by them; others are skipped.
    """
    spark = store.spark
    if source not in schemas.SOURCE_IDS:
        raise ValueError(f"unknown source {source!r}")
    now = now or datetime.datetime.now(datetime.timezone.utc)
    datasets = store.read("datasets")
    name = delimited.parse_file_name(F.col("file_name"))
    facts = {r.file_path: r for r in gate(file_facts(spark, paths), datasets).withColumns({"year": name["year"], "area": name["subject_area"]}).orderBy("file_path").collect()}  # one row a file
    said = dict.fromkeys(facts, "skipped")
    if len(facts) < len(paths):
        said |= dict.fromkeys(delimited.empty_files(spark, paths), "failed: no line")
    todo = [r for r in facts.values() if r.action != "skip" and not (source == "SCIMAGO" and r.year is None)]
    limits, top_id = schemas.TABLES["datasets"].lengths, datasets.agg(F.max("id")).first()[0] or 0
    ids, long_names = {}, {}
    for r in todo:
        if r.action == "retry":
            ids[r.file_path] = r.dataset_id
        else:
            top_id += 1
            ids[r.file_path] = top_id
        if len(r.file_name) > limits["file_name"] or len(r.area or "") > limits["subject_area"] or len(r.file_path) > schemas.TABLES["raw_files"].lengths["file_path"]:
            long_names[r.file_path] = "its name is too long"

    def marked(status: dict[str, str], counts: dict[str, int]) -> DataFrame:
        rows = [(ids[p], schemas.SOURCE_IDS[source], facts[p].year if source == "SCIMAGO" else DATASET_YEARS[source], (facts[p].area or "")[: limits["subject_area"]] or None if source == "SCIMAGO" else None, facts[p].file_name[: limits["file_name"]], facts[p].sha256, now, counts.get(p), s) for p, s in status.items()]
        new = spark.createDataFrame(rows, schemas.TABLES["datasets"].schema)
        return datasets.join(new.select("id"), "id", "left_anti").unionByName(new)

    readable = [p for p in ids if p not in long_names]
    failed, loaded = dict(long_names), []
    try:
        batch = _gather(spark, source, readable) if readable else _Batch()
        failed |= batch.failed
        loaded = [p for p in readable if p not in failed]
        tables, counts = _numbered_tables(store, source, batch, {p: (ids[p], facts[p]) for p in loaded}, now) if loaded else ({}, {})
        if ids:
            status = {p: "failed" if p in failed else "loaded" for p in ids}
            store.publish({"datasets": marked(status, counts)}, append=tables)
    except Exception:
        store.publish({"datasets": marked(dict.fromkeys(ids, "failed"), {})})
        raise
    return said | dict.fromkeys(loaded, "loaded") | {p: f"failed: {why}" for p, why in failed.items()}


def load_file(store: state.Store, source: str, path: str, now: datetime.datetime | None = None) -> str:
    """Load one file: 'skipped', 'loaded', or an error after its dataset is marked as failed."""
    (said,) = import_files(store, source, [path], now).values()
    if said.startswith("failed: "):
        raise ValueError(said.removeprefix("failed: "))
    return said


def _numbered_tables(store: state.Store, source: str, batch: _Batch, files: dict[str, tuple], now: datetime.datetime) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """The rows that loading files adds, by table, and the number of each file's records."""
    spark = store.spark
    top = lambda name: store.read(name).agg(F.max("id")).first()[0] or 0
    first_file, names = top("raw_files") + 1, {p: uri for uri, p in batch.names.items()}
    facts = [(first_file + k, dataset_id, fact.file_path, fact.sha256, fact.file_size, PARSER_VERSION, now) for k, (dataset_id, fact) in enumerate(files.values())]
    raw_files = spark.createDataFrame(facts, schemas.TABLES["raw_files"].schema)
    keys = spark.createDataFrame([(names[p], first_file + k, dataset_id) for k, (p, (dataset_id, _)) in enumerate(files.items())], "_file string, raw_file_id long, dataset_id long")
    lines = batch.raw.join(keys, "_file")
    # Rows of a file are numbered without a gap, so a file's rows have ids from the number of rows in the files before.
    sizes = lines.groupBy("raw_file_id").agg(F.count("*").alias("_n"))
    before = Window.orderBy("raw_file_id").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    offsets = sizes.select("raw_file_id", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + top("raw_rows")).alias("_before"))
    raw_rows = lines.join(offsets, "raw_file_id").select("_file", (F.col("_before") + F.col("_row_number")).alias("id"), "raw_file_id", "dataset_id", F.col("_row_number").alias("row_number"), F.col("raw_json").alias("raw_data"))
    table = schemas.RECORD_TABLES[source]
    order = ["raw_row_id", *[k for k in RECORD_KEYS[source] if k.endswith("year")]]
    valid = batch.valid.withColumnRenamed("_row_number", "row_number").join(raw_rows.select("_file", "row_number", F.col("id").alias("raw_row_id"), "dataset_id"), ["_file", "row_number"])
    records = state.durable(state.next_ids(valid, order, top(table)).withColumn("imported_at", F.lit(now)))
    rejected = batch.rejected.join(keys, "_file")
    out = {
        "raw_files": raw_files,
        "raw_rows": raw_rows,
        table: records,
        "ingestion_rejections": state.next_ids(rejected, ["raw_file_id", "row_number", "reason"], top("ingestion_rejections")).withColumn("created_at", F.lit(now)),
    }
    if source == "SCIMAGO":
        categories = records.select(F.col("id").alias("scimago_record_id"), F.posexplode("categories").alias("pos", "c")).select("scimago_record_id", "pos", "c.category_name", "c.quartile")
        areas = records.select(F.col("id").alias("scimago_record_id"), F.posexplode("areas").alias("pos", "area_name"))
        for name, child in (("scimago_categories", categories), ("scimago_areas", areas)):
            out[name] = state.next_ids(child, ["scimago_record_id", "pos"], top(name))
    counted = {r.dataset_id: r.n for r in records.groupBy("dataset_id").agg(F.count("*").alias("n")).collect()}  # one row a file
    return out, {p: counted.get(dataset_id, 0) for p, (dataset_id, _) in files.items()}


def reset_dataset(store: state.Store, dataset_id: int, table: str) -> int:
    """Take out a dataset's records, their dependents, raw rows and files, and set it to pending; rejections stay."""
    if table not in schemas.RECORD_TABLES.values():
        raise ValueError(f"{table!r} is no record table")
    datasets, records, files, rows = (store.read(x) for x in ("datasets", table, "raw_files", "raw_rows"))
    if not datasets.where(F.col("id") == dataset_id).limit(1).count():
        raise ValueError(f"there is no dataset {dataset_id}")
    gone = records.where(F.col("dataset_id") == dataset_id).select(F.col("id").alias("scimago_record_id"))
    out = {name: store.read(name).join(gone, "scimago_record_id", "left_anti") for name in DEPENDENTS} if table == "scimago_records" else {}
    out[table] = records.where(F.col("dataset_id") != dataset_id)
    out["raw_rows"] = rows.join(files.where(F.col("dataset_id") == dataset_id).select(F.col("id").alias("raw_file_id")), "raw_file_id", "left_anti")
    out["raw_files"] = files.where(F.col("dataset_id") != dataset_id)
    here = F.col("id") == dataset_id
    out["datasets"] = datasets.withColumns({"status": F.when(here, "pending").otherwise(F.col("status")), "record_count": F.when(~here, F.col("record_count"))})
    return store.publish(out)
