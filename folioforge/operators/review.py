"""The human review loop: export the pending queue, read decisions back, apply those that aren't stale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalars as S
from . import candidates as C
from . import state

# The columns of an exported queue, and the decisions that a reviewer can take.
EXPORT_COLUMNS = ("exported_at", "candidate_id", "source", "source_record_id", "source_record_display_name", "candidate_journal_id", "candidate_journal_title", "similarity", "issn_match", "publisher_match", "rank_among_candidates", "decision")
DECISIONS = ("accepted", "new_journal", "rejected_no_match")
TABLE_OF = {code: schemas.RECORD_TABLES[code] for code in ("ABDC", "ABS", "REPEC", "FT50")}
NAME_OF = {"ABDC": "journal_name", "ABS": "journal_name", "REPEC": "journal_name_clean", "FT50": "journal_name"}


def display_names(store: state.Store) -> DataFrame:
    """(source_record_table, source_record_id, name) of all reviewed sources' records."""
    out = None
    for code, table in TABLE_OF.items():
        part = store.read(table).select(F.lit(table).alias("source_record_table"), F.col("id").alias("source_record_id"), F.col(NAME_OF[code]).alias("name"))
        out = part if out is None else out.unionByName(part)
    return out


def pending_queue(candidates: DataFrame, names: DataFrame, journals: DataFrame, exported_at: Column) -> DataFrame:
    """The open candidates for a reviewer, one export time for all; a record without a name is an error when it's written."""
    codes = S.lookup(F.col("source_id"), {k: code for code, k in schemas.SOURCE_IDS.items()})
    open_ = candidates.where("review_status = 'pending'").join(names, ["source_record_table", "source_record_id"], "left")
    titled = open_.join(journals.select(F.col("id").alias("candidate_journal_id"), F.col("canonical_title").alias("candidate_journal_title")), "candidate_journal_id")
    shown = F.when(S.is_missing("name"), F.raise_error(F.concat(F.lit("no display name: "), "source_record_table", F.lit(" "), F.col("source_record_id").cast("string"))).cast("string")).otherwise(F.col("name"))
    return titled.select(
        S.utc_text(exported_at).alias("exported_at"), F.col("id").alias("candidate_id"), codes.alias("source"), "source_record_id", shown.alias("source_record_display_name"), "candidate_journal_id", "candidate_journal_title", "similarity", "issn_match", "publisher_match", "rank_among_candidates", F.lit("").alias("decision")
    )


def export_pending(store: state.Store, path: str, exported_at: Column | None = None) -> int:
    queue = pending_queue(store.read("entity_match_candidates"), display_names(store), store.read("journals"), exported_at if exported_at is not None else F.current_timestamp())
    state.write_report(queue.orderBy("source", "source_record_id", "rank_among_candidates", "candidate_id"), path)
    return store.spark.read.csv(path, header=True).count()


def normalize_decision(value: Column | str) -> Column:
    """A decision that a reviewer can take, whatever its case and the space around it; null for anything else."""
    text = F.lower(S.strip(value))
    return F.when(text.isin(*DECISIONS), text)


def parse_positive(value: Column | str) -> Column:
    number = S.parse_int(value)
    return F.when(number > 0, number)


def check_rows(rows: DataFrame) -> DataFrame:
    """rows that hold a decision, parsed, with their problems; a row with a blank decision is ignored."""
    decided = rows.where(~S.is_missing("decision"))
    parsed = decided.withColumns({"candidate_id": parse_positive("candidate_id"), "source": F.upper(S.strip("source")), "source_record_id": parse_positive("source_record_id"), "candidate_journal_id": parse_positive("candidate_journal_id"), "csv_decision": normalize_decision("decision")})
    tests = {
        "invalid_candidate_id": F.col("candidate_id").isNull(),
        "invalid_source": ~F.col("source").isin(*TABLE_OF),
        "invalid_source_record_id": F.col("source_record_id").isNull(),
        "invalid_candidate_journal_id": F.col("candidate_journal_id").isNull(),
        "invalid_decision": F.col("csv_decision").isNull(),
    }
    found = F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(True)), F.lit(n)) for n, t in tests.items()]))
    return parsed.withColumn("problems", found)


def group_conflicts(decided: DataFrame) -> DataFrame:
    """Records whose rows disagree: two decisions, or an acceptance that doesn't name one candidate."""
    groups = decided.groupBy("source", "source_record_id").agg(F.count_distinct("csv_decision").alias("decisions"), F.count_distinct("candidate_id").alias("candidates"), F.max(F.col("csv_decision") == "accepted").alias("accepts"))
    return groups.where("decisions > 1 or (accepts and candidates <> 1)")


def apply_decisions(store: state.Store, rows: DataFrame, reviewer: str, now: Column | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """(changed tables, stale rows) of a reviewer's decisions.

    Rows of candidates that aren't pending any more are stale and change nothing. A malformed row, a disagreement
    within a record, and a row that doesn't fit its candidate are errors. A new journal takes its title's matching key,
    and a journal that has the same key is used.
    """
    if not reviewer:
        raise ValueError("a reviewer is needed")
    now = now if now is not None else F.current_timestamp()
    decided = state.durable(check_rows(rows))
    if bad := decided.where(F.size("problems") > 0).limit(3).collect():
        raise ValueError(f"malformed rows: {[(r.candidate_id, r.problems) for r in bad]}")
    if bad := group_conflicts(decided).limit(3).collect():
        raise ValueError(f"contradictory decisions: {[(r.source, r.source_record_id) for r in bad]}")
    candidates, journals = store.read("entity_match_candidates"), store.read("journals")
    mine = decided.select("candidate_id", "csv_decision", F.col("source_record_id").alias("_record"), F.col("candidate_journal_id").alias("_journal"), S.lookup("source", TABLE_OF).alias("_table"))
    joined = mine.join(candidates.withColumnRenamed("id", "candidate_id"), "candidate_id", "left")
    if bad := joined.where("source_id is null or _record <> source_record_id or _journal <> candidate_journal_id or _table <> source_record_table").limit(3).collect():
        raise ValueError(f"rows that don't fit their candidate: {[r.candidate_id for r in bad]}")
    stale = joined.where("review_status <> 'pending'").select("candidate_id", "csv_decision", F.col("review_status").alias("current_db_status"))
    live = joined.where("review_status = 'pending'").select(*C.REFERENCE, "candidate_journal_id", "similarity", "csv_decision")
    one = live.dropDuplicates([*C.REFERENCE, "csv_decision"])
    accepted = one.where("csv_decision = 'accepted'")
    closed = C.accept_and_close(candidates, accepted.select(*C.KEY), reviewer, now, sign_siblings=True)
    others = one.where("csv_decision <> 'accepted'").select(*C.REFERENCE, F.lit(True).alias("_shut"))
    shut = F.col("_shut").isNotNull() & (F.col("review_status") == "pending")
    closed = closed.join(others, list(C.REFERENCE), "left").withColumns({"reviewed_by": F.when(shut, reviewer).otherwise(F.col("reviewed_by")), "reviewed_at": F.when(shut, now).otherwise(F.col("reviewed_at")), "review_status": F.when(shut, "rejected").otherwise(F.col("review_status"))}).select(*candidates.columns)
    new = one.where("csv_decision = 'new_journal'").join(display_names(store), ["source_record_table", "source_record_id"]).withColumns({"title": S.normalize_title("name"), "key": S.matching_title("name")})
    known = journals.groupBy(F.col("normalized_title").alias("key")).agg(F.min("id").alias("known"))
    wanted = new.join(known, "key", "left")
    fresh = wanted.where("known is null").groupBy("key").agg(F.min("title").alias("canonical_title"))
    made = state.next_ids(fresh, ["key"], journals.agg(F.max("id")).first()[0] or 0)
    named = wanted.join(made.select("key", F.col("id").alias("made")), "key", "left")
    final = state.durable(
        accepted.select(*C.REFERENCE, F.col("candidate_journal_id").alias("journal_id"), F.lit("manually_confirmed").alias("match_method"), F.col("similarity").alias("confidence"), F.lit("manually_confirmed").alias("decision"))
        .unionByName(named.select(*C.REFERENCE, F.coalesce("known", "made").alias("journal_id"), F.lit("new_journal").alias("match_method"), F.lit(1).cast("decimal(5,4)").alias("confidence"), F.lit("new_journal").alias("decision")))
        .unionByName(one.where("csv_decision = 'rejected_no_match'").select(*C.REFERENCE, F.lit(None).cast("long").alias("journal_id"), F.lit("rejected_no_match").alias("match_method"), F.lit(None).cast("decimal(5,4)").alias("confidence"), F.lit("rejected_no_match").alias("decision")))
    ).persist()
    out = {
        "entity_match_candidates": closed,
        "entity_match_decisions": state.insert_absent(store.read("entity_match_decisions"), schemas.conform(final.withColumns({"reviewed_by": F.lit(reviewer), "reviewed_at": now}), "entity_match_decisions"), C.REFERENCE),
        "journal_source_mapping": state.insert_absent(store.read("journal_source_mapping"), schemas.conform(final.where("journal_id is not null").withColumns({"match_score": S.rounded("confidence", 3), "match_status": F.when(F.col("decision") == "new_journal", "new_journal").otherwise("accepted")}), "journal_source_mapping"), C.REFERENCE),
        "journals": journals.unionByName(schemas.conform(made.withColumn("normalized_title", F.col("key")).withColumns({"created_at": now, "updated_at": now}), "journals")),
    }
    for table in TABLE_OF.values():
        links = final.where((F.col("source_record_table") == table) & F.col("journal_id").isNotNull()).select(F.col("source_record_id").alias("id"), "journal_id")
        out[table] = state.update_by_key(store.read(table), links, ["id"], ["journal_id"])
    return out, stale
