"""Match candidates: evidence merged by record and journal, and the closing of a record's queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REFERENCE = ("source_id", "source_record_table", "source_record_id")
KEY = (*REFERENCE, "candidate_journal_id")


def merge_methods(old: Column, new: Column) -> Column:
    """One name for two methods: the same, the one there is, the one that holds the other, or both joined by +."""
    return F.when(old.isNull(), new).when(new.isNull() | (old == new), old).when(F.contains(old, new), old).when(F.contains(new, old), new).otherwise(F.concat(old, F.lit("+"), new))


def fold(evidence: DataFrame, key=KEY, order: str = "seq") -> DataFrame:
    """One row a key from several pieces of evidence: the largest similarity, any true flag, methods merged in order, the best rank."""
    # First by method, so that a key's list is no longer than there are methods; a method that comes again changes nothing.
    values = [F.max("similarity").alias("similarity"), F.max(F.coalesce("issn_match", F.lit(False))).alias("issn_match"), F.max(F.coalesce("publisher_match", F.lit(False))).alias("publisher_match"), F.min("rank_among_candidates").alias("rank_among_candidates")]
    each = evidence.groupBy(*key, "match_method").agg(F.min(order).alias(order), *values)
    methods = F.transform(F.array_sort(F.collect_list(F.struct(order, "match_method"))), lambda x: x["match_method"])
    merged = F.aggregate(methods, F.lit(None).cast("string"), merge_methods)
    return each.groupBy(*key).agg(*values[:3], merged.alias("match_method"), values[3])


def upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """old with new evidence merged in; reviewed rows are left alone. Rows that are new come without an id and are pending.

    new has at most one row a key, see fold().
    """
    values = ("similarity", "issn_match", "publisher_match", "match_method", "rank_among_candidates")
    added = new.select(*KEY, *[F.col(c).alias(f"_{c}") for c in values], F.lit(True).alias("_new"))
    both = old.withColumn("_old", F.lit(True)).join(added, list(KEY), "full")
    open_ = (F.col("review_status") == "pending") & F.col("_new").isNotNull()
    fresh = F.col("_old").isNull()
    merged = {
        "similarity": F.greatest("similarity", "_similarity"),
        "issn_match": F.when(F.col("_issn_match"), True).otherwise(F.col("issn_match")),
        "publisher_match": F.when(F.col("_publisher_match"), True).otherwise(F.col("publisher_match")),
        "match_method": merge_methods(F.col("match_method"), F.col("_match_method")),
        "rank_among_candidates": F.least("rank_among_candidates", "_rank_among_candidates"),
    }
    out = []
    for c in old.columns:
        kind = old.schema[c].dataType
        if c in merged:
            out.append(F.when(fresh, F.col(f"_{c}")).when(open_, merged[c]).otherwise(F.col(c)).cast(kind).alias(c))
        elif c == "review_status":
            out.append(F.when(fresh, "pending").otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return both.select(*out)


def best(candidates: DataFrame) -> DataFrame:
    """The best candidate of each record that isn't rejected: highest similarity, then best rank, then lowest journal."""
    order = (F.desc_nulls_last("similarity"), F.asc_nulls_last("rank_among_candidates"), F.asc("candidate_journal_id"))
    place = F.row_number().over(Window.partitionBy(*REFERENCE).orderBy(*order))
    return candidates.where("review_status <> 'rejected'").withColumn("_place", place).where("_place = 1").drop("_place")


def accept_and_close(candidates: DataFrame, accepted: DataFrame, by: str = "system_auto", at: Column | None = None, sign_siblings: bool = False) -> DataFrame:
    """Accept the rows of accepted (KEY columns, one a record) and reject their pending siblings.

    A row that's accepted already stays so; a rejected one, or a record with another accepted row, is an error when
    the result is made. With sign_siblings, rejected siblings carry the reviewer too.
    """
    at = at if at is not None else F.lit(None).cast("timestamp")
    chosen = accepted.select(*REFERENCE, F.col("candidate_journal_id").alias("_chosen"))
    joined = candidates.join(chosen, list(REFERENCE), "left")
    mine, sibling = F.col("candidate_journal_id") == F.col("_chosen"), F.col("candidate_journal_id") != F.col("_chosen")
    status = F.col("review_status")
    wrong = (mine & (status == "rejected")) | (sibling & (status == "accepted"))
    opened = status == "pending"
    new = F.when(wrong, F.raise_error(F.lit("a rejected candidate can't be accepted, nor a second one of a record")).cast("string")).when(mine, "accepted").when(sibling & opened, "rejected").otherwise(status)
    signed = opened & (mine | sibling if sign_siblings else mine)
    return joined.withColumns({"review_status": new, "reviewed_by": F.when(F.coalesce(signed, F.lit(False)), by).otherwise(F.col("reviewed_by")), "reviewed_at": F.when(F.coalesce(signed, F.lit(False)), at).otherwise(F.col("reviewed_at"))}).drop("_chosen")
