"""Read-only checks of the loaded tables; each returns its report as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalars as S
from ..functions import similarity as sim
from . import resolve

# Fixed values of the checks.
SAMPLE, DROP = 500, 0.050
ONE_TO_MANY = {"SCIMAGO": False, "ABDC": False, "ABS": True, "REPEC": False, "FT50": False}


def history_gaps(rows: DataFrame, key: str, year: str, title: DataFrame | None = None) -> DataFrame:
    """(key, missing_year, previous_year, next_year): years Y + 1 that a key lacks though it has Y and Y + 2."""
    years = rows.where(F.col(key).isNotNull()).select(key, F.col(year).alias("previous_year")).distinct()
    following = F.lead("previous_year").over(Window.partitionBy(key).orderBy("previous_year"))
    gaps = years.withColumn("next_year", following).where("next_year = previous_year + 2").select(key, (F.col("previous_year") + 1).alias("missing_year"), "previous_year", "next_year")
    return gaps if title is None else gaps.join(title, key).select(key, "canonical_title", "missing_year", "previous_year", "next_year")


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def open_conflicts(conflicts: DataFrame, candidates: DataFrame) -> DataFrame:
    """Conflicts with the journals in them that still have pending candidates."""
    each = conflicts.select("identifier", F.explode("journal_ids").alias("candidate_journal_id")).distinct()
    return each.join(candidates.where("review_status = 'pending'").select("candidate_journal_id").distinct(), "candidate_journal_id", "left_semi")


def ordered_sample(rows: DataFrame, keys: list[str], n: int = SAMPLE) -> DataFrame:
    """The first n rows by keys: a fixed sample, part of the report's definition."""
    return rows.orderBy(*keys).limit(n)


def drift_evidence(accepted: DataFrame, titles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(own, beaten): (key, journal_id, own) the score of each accepted pair of one block; (key, journal_id) of those that another title beats.

    The accepted pair is scored first; what could beat it has its score at least. For a pair that is still alike that is a
    similarity join, so that a frequent block isn't scored whole; only pairs that have fallen below its
    threshold, and titles shorter than a block, are held against all titles that begin alike.
    """
    others = titles.select(F.col("journal_id"), F.col("normalized_title").alias("other")).where("other <> ''")
    pairs = accepted.select("key", "journal_id").where("key <> ''").distinct().join(others, "journal_id").where(F.startswith("other", sim.title_block_of("key")))
    pairs = pairs.withColumns({"a": sim.token_sort("key"), "b": sim.token_sort("other")}).withColumn("lcs", sim.lcs_length("a", "b"))
    own = pairs.select("key", "journal_id", sim.similarity(F.col("lcs"), F.col("a"), F.col("b")).alias("own"))
    alike = (F.col("own") >= resolve.CANDIDATE / 1000) & (F.length("key") >= 4)
    near = resolve.similar_titles(own.where(alike), others).unionByName(resolve.prefix_titles(own.where(~alike), others))
    rivals = own.join(near, "key").where("score >= own").join(others.withColumnRenamed("journal_id", "_rival"), "other")
    return own, rivals.where((F.col("score") > F.col("own")) | (F.col("_rival") < F.col("journal_id"))).select("key", "journal_id").distinct()


def match_drift(accepted: DataFrame, titles: DataFrame, drop: float = DROP) -> DataFrame:
    """Accepted matches whose score, made anew against all journals, fell by `drop` or more, or now names another journal.

    accepted: source_record_table, source_record_id, journal_id, accepted_score decimal(5,4), accepted_at, key.
    titles: journal_id, normalized_title.
    """
    own, beaten = drift_evidence(accepted, titles)
    joined = accepted.join(own, ["key", "journal_id"], "left").join(beaten.withColumn("_beaten", F.lit(True)), ["key", "journal_id"], "left")
    joined = joined.withColumn("recomputed_score", S.rounded("own", 4))
    same = F.col("own").isNotNull() & F.col("_beaten").isNull()
    fell = F.col("accepted_score") - F.col("recomputed_score")
    reason = F.when(~same, "not_recomputable").when(fell >= drop, "score_drop")
    return joined.withColumns({"recomputed_score": F.when(same, F.col("recomputed_score")), "score_drop": F.when(same, fell), "reason": reason}).where("reason is not null").select("source_record_table", "source_record_id", "journal_id", "accepted_score", "recomputed_score", "score_drop", "accepted_at", "reason")


def drift_sample(candidates: DataFrame, names: DataFrame, n: int = SAMPLE) -> DataFrame:
    """The sample that drift is checked on: accepted rows whose method begins with fuzzy_title."""
    fuzzy = candidates.where("review_status = 'accepted' and match_method like 'fuzzy_title%'")
    rows = ordered_sample(fuzzy, ["source_record_table", "source_record_id"], n).join(names, ["source_record_table", "source_record_id"], "left")
    return rows.select("source_record_table", "source_record_id", F.col("candidate_journal_id").alias("journal_id"), F.col("similarity").alias("accepted_score"), F.col("reviewed_at").alias("accepted_at"), S.matching_title("name").alias("key"))


def dangling(references: DataFrame, tables: dict[str, DataFrame], n: int | None = SAMPLE) -> DataFrame:
    """References (source_record_table, source_record_id, ..) whose table isn't known or has no such id; of the first n, or of all."""
    checked = references if n is None else ordered_sample(references, ["source_record_table", "source_record_id"], n)
    ids = None
    for name, df in tables.items():
        part = df.select(F.lit(name).alias("source_record_table"), F.col("id").cast("long").alias("source_record_id"))
        ids = part if ids is None else ids.unionByName(part)
    lost = checked.join(ids, ["source_record_table", "source_record_id"], "left_anti")
    return lost.withColumn("reason", F.when(F.col("source_record_table").isin(*tables), "source_record_missing").otherwise("unknown_source_table"))


def _bits(rows: DataFrame, *by: str) -> DataFrame:
    """(by, bucket, bits): the rows' ids as bits, a row for each bucket of them."""
    bucket = F.bitmap_bucket_number("raw_row_id").alias("bucket")
    return rows.groupBy(*by, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("raw_row_id")).alias("bits"))


def lineage(datasets: DataFrame, raw_rows: DataFrame, raw_files: DataFrame, rejections: DataFrame, records: dict[str, DataFrame]) -> DataFrame:
    """One row a loaded dataset: raw rows against records and rejections.

    A row counts as rejected once, however many problems it has, and only if no record came from it; rows that repeat
    another, or that have no rating at all, are told apart as skipped, so that a clean dataset passes.

    Rows are sets of bits of their ids, 32,768 a row, so raw rows and records are never joined one by one: what is counted
    are bits of the sets' unions. Only rejected rows are looked up by their place in a file.
    """
    code = S.lookup("source_id", {k: c for c, k in schemas.SOURCE_IDS.items()})
    loaded = datasets.where("status = 'loaded'").select(F.col("id").alias("dataset_id"), code.alias("source_code"))
    files = raw_files.select(F.col("id").alias("raw_file_id"), "dataset_id")
    raw = raw_rows.select(F.col("id").alias("raw_row_id"), "raw_file_id", "row_number").join(files, "raw_file_id")
    made = None
    for source, df in records.items():
        part = df.select("dataset_id", "raw_row_id", F.lit(source).alias("source_code"))
        made = part if made is None else made.unionByName(part)
    bad = rejections.select("dataset_id", "raw_file_id", "row_number").distinct().join(raw, ["dataset_id", "raw_file_id", "row_number"])
    kinds = lambda kind, df: df.select("dataset_id", "bucket", F.lit(kind).alias("kind"), "bits")
    there, own = _bits(raw, "dataset_id"), _bits(made.where("raw_row_id is not null"), "dataset_id")
    from_any = own.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits")).join(there.select("dataset_id", "bucket"), "bucket")
    sets = kinds("raw", there).unionByName(kinds("made", from_any)).unionByName(kinds("bad", _bits(bad, "dataset_id")))
    union = lambda *of: F.coalesce(F.bitmap_count(F.bitmap_or_agg(F.when(F.col("kind").isin(*of), F.col("bits")))), F.lit(0))
    counted = sets.groupBy("dataset_id", "bucket").agg(union("raw").alias("r"), union("made").alias("m"), union("made", "raw").alias("mr"), union("made", "bad").alias("mb"), union("made", "bad", "raw").alias("mbr"))
    # Of the raw rows, those with a record, and those with a record or a rejection.
    with_record, told = F.col("r") + F.col("m") - F.col("mr"), F.col("r") + F.col("mb") - F.col("mbr")
    rows = counted.groupBy("dataset_id").agg(F.sum("r").alias("raw_rows"), F.sum(told - with_record).alias("ingestion_rejections"), F.sum(F.col("r") - told).alias("skipped_rows"))
    counts = made.groupBy("dataset_id").agg(F.count("*").alias("normalized_records")).join(own.groupBy("dataset_id").agg(F.sum(F.bitmap_count("bits")).alias("distinct_source_rows")), "dataset_id", "left")
    many = F.col("source_code").isin(*[s for s, x in ONE_TO_MANY.items() if x])
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    full = loaded.join(rows, "dataset_id", "left").join(counts, "dataset_id", "left").withColumns({c: zero(F.col(c)) for c in ("raw_rows", "ingestion_rejections", "skipped_rows", "normalized_records", "distinct_source_rows")})
    expected = F.when(many, F.col("distinct_source_rows")).otherwise(F.col("normalized_records")) + F.col("ingestion_rejections") + F.col("skipped_rows")
    out = full.withColumns({"expected_normalized_count": expected, "actual_normalized_count": F.col("raw_rows"), "difference": F.col("raw_rows") - expected, "one_to_many": many})
    return out.select("source_code", "dataset_id", "raw_rows", "normalized_records", "distinct_source_rows", "ingestion_rejections", "skipped_rows", "expected_normalized_count", "actual_normalized_count", "difference", "one_to_many", F.when(F.col("difference") == 0, "PASS").otherwise("FAIL").alias("status"))


def coverage(records: DataFrame, decisions: DataFrame, key: list[str], by: str) -> DataFrame:
    """One row for each value of by: total, accepted (also confirmed by hand), new_journal, rejected_no_match, pending, and whether they add up."""
    decided = decisions.select(*key, "decision")
    joined = records.join(decided, key, "left")
    is_ = lambda *names: F.count(F.when(F.col("decision").isin(*names), 1))
    out = joined.groupBy(by).agg(F.count("*").alias("total"), is_("accepted", "manually_confirmed").alias("accepted"), is_("new_journal").alias("new_journal"), is_("rejected_no_match").alias("rejected_no_match"), F.count(F.when(F.col("decision").isNull(), 1)).alias("pending"))
    return out.withColumn("adds_up", F.col("total") == F.col("accepted") + F.col("new_journal") + F.col("rejected_no_match") + F.col("pending"))


def coverage_of(store) -> DataFrame:
    """Coverage of the five sources, loaded datasets only."""
    loaded = store.read("datasets").where("status = 'loaded'").select(F.col("id").alias("dataset_id"))
    out = None
    for source, table in schemas.RECORD_TABLES.items():
        part = store.read(table).join(loaded, "dataset_id", "left_semi").select(F.lit(source).alias("source_code"), F.lit(table).alias("source_record_table"), F.col("id").alias("source_record_id"))
        out = part if out is None else out.unionByName(part)
    return coverage(out, store.read("entity_match_decisions"), ["source_record_table", "source_record_id"], "source_code")


def coverage_text(rows: DataFrame, journals: int) -> str:
    """The report of a few rows as text; sources in their order."""
    found = {r.source_code: r for r in rows.collect()}
    lines = ["Coverage report", f"Canonical journals: {journals}"]
    for code in schemas.SOURCE_IDS:
        if r := found.get(code):
            if not r.adds_up:
                raise ValueError(f"{code} doesn't add up")
            lines.append(f"{code}: total={r.total} matched={r.accepted} new={r.new_journal} rejected={r.rejected_no_match} pending={r.pending}")
    lines.append(f"Pending downstream: {sum(r.pending for c, r in found.items() if c != 'SCIMAGO')}")
    return "\n".join(lines) + "\n"
