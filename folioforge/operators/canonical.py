"""The canonical dimension, seeded from the source whose own id is authoritative."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalars as S
from . import state

TABLE = "scimago_records"


def representative(records: DataFrame, key: str = "sourceid", year: str = "year", publisher: str = "publisher_raw", area: str = "subject_area", row: str = "id") -> DataFrame:
    """One row a key: the latest year, then one with a publisher, then the first area whatever its case, then the lowest row."""
    order = (F.desc_nulls_last(year), S.is_missing(publisher).asc(), F.lower(area), F.col(area), F.col(row))
    return records.withColumn("_place", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_place = 1").drop("_place")


def first_source_ids(records: DataFrame, n: int) -> DataFrame:
    """The records of the first n source ids in text order, to try a seed on a part; what it returns is not to be published."""
    if n < 1:
        raise ValueError("n has to be positive")
    return records.join(records.select("sourceid").distinct().orderBy("sourceid").limit(n), "sourceid", "left_semi")


def title_variants(records: DataFrame, chosen: DataFrame, key: str = "sourceid", title: str = "title") -> DataFrame:
    """(key, variants): the sorted other titles of each key, white space cleaned; chosen has the representative as `shown`."""
    sets = records.groupBy(key).agg(F.collect_set(S.normalize_title(title)).alias("_titles"))
    return sets.join(chosen.select(key, "shown"), key).select(key, F.array_sort(F.array_except("_titles", F.array("shown", F.lit("")))).alias("variants"))


def issn_owners(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(owned, conflicts): each identifier goes to the first source id in text order; the others' claims are conflicts.

    Identifiers of a source id stand in the order of its rows, newest year first, then of their place in the row.
    """
    each = records.select("sourceid", "year", "subject_area", "id", F.posexplode(F.split("issn_raw", ",")).alias("pos", "part")).withColumn("identifier_value", S.strip("part")).withColumn("normalized_value", S.normalize_issn("part")).where("normalized_value is not null")
    # The first claim of a source id and the first source id of a value are met by partial aggregation, however frequent they are.
    newest = F.struct(F.col("year").isNull().alias("none"), (-F.col("year")).alias("back"), "subject_area", "id", "pos", "identifier_value")
    claims = each.groupBy("sourceid", "normalized_value").agg(F.min(newest)["identifier_value"].alias("identifier_value"))
    owners = each.groupBy("normalized_value").agg(F.min("sourceid").alias("owner"))
    told = state.join_one(claims, owners, "normalized_value").select("sourceid", "identifier_value", "normalized_value", "owner")
    return told.where("sourceid = owner").drop("owner"), told.where("sourceid > owner")


def seed(records: DataFrame, base: int = 0, identifiers: DataFrame | None = None, now: Column | None = None) -> dict[str, DataFrame]:
    """Journals, identifiers, aliases, mappings, decisions and linked records from records of the authoritative source.

    A source id makes one journal, ids in the order of source ids after base. Identifiers that identifiers holds
    already, and claims of later source ids, are conflicts and stay where they are. A title that is empty, or has no
    matching key, is an error when the journals are made.
    """
    spark, source = records.sparkSession, schemas.SOURCE_IDS["SCIMAGO"]
    now = now if now is not None else F.lit(None).cast("timestamp")
    first_year = records.groupBy("sourceid").agg(F.min("year").alias("first_observed_year"))
    shown = representative(records).withColumn("shown", S.normalize_title("title")).withColumn("normalized_title", S.matching_title("title"))
    sound = F.when((F.col("shown") == "") | (F.col("normalized_title") == ""), F.raise_error(F.concat(F.lit("no usable title: source id "), "sourceid")).cast("string")).otherwise(F.col("normalized_title"))
    made = state.next_ids(shown.withColumn("normalized_title", sound).join(first_year, "sourceid").select("sourceid", "shown", "normalized_title", F.col("publisher_raw").alias("publisher"), "first_observed_year"), ["sourceid"], base)
    made = state.durable(made)
    ids = made.select("sourceid", F.col("id").alias("journal_id"))
    owned, conflicts = issn_owners(records)
    if identifiers is not None:
        taken = identifiers.where("identifier_type = 'ISSN'").select("normalized_value")
        conflicts = conflicts.unionByName(owned.join(taken, "normalized_value", "left_semi").withColumn("owner", F.lit(None).cast("string")))
        owned = owned.join(taken, "normalized_value", "left_anti")
    by_source = ids.select("journal_id", F.lit("SCIMAGO_SOURCE_ID").alias("identifier_type"), F.col("sourceid").alias("identifier_value"))
    by_issn = owned.join(ids, "sourceid").select("journal_id", F.lit("ISSN").alias("identifier_type"), "identifier_value")
    named = by_source.unionByName(by_issn).withColumns({"normalized_value": S.normalize_identifier("identifier_type", "identifier_value"), "source_id": F.lit(source), "is_primary": F.lit(False)})
    aliases = title_variants(records, made).join(ids, "sourceid").select("journal_id", F.explode("variants").alias("alias_name")).withColumn("normalized_alias", S.matching_title("alias_name"))
    aliases = state.insert_absent(spark.createDataFrame([], "journal_id long, normalized_alias string"), aliases, ("journal_id", "normalized_alias"), ["alias_name"]).withColumn("source_id", F.lit(source))
    linked = records.drop("journal_id").join(ids, "sourceid")
    reference = linked.select("journal_id", F.lit(source).alias("source_id"), F.lit(TABLE).alias("source_record_table"), F.col("id").alias("source_record_id"), F.lit("source_id").alias("match_method"))
    return {
        "journals": schemas.conform(made.withColumnRenamed("shown", "canonical_title").withColumns({"created_at": now, "updated_at": now}), "journals"),
        "journal_identifiers": schemas.conform(named, "journal_identifiers"),
        "journal_aliases": schemas.conform(aliases, "journal_aliases"),
        "journal_source_mapping": schemas.conform(reference.withColumns({"match_score": F.lit(1), "match_status": F.lit("accepted")}), "journal_source_mapping"),
        "entity_match_decisions": schemas.conform(reference.withColumns({"confidence": F.lit(1), "decision": F.lit("accepted"), "reviewed_by": F.lit("system_auto"), "reviewed_at": now}), "entity_match_decisions"),
        TABLE: schemas.conform(linked, TABLE),
        "conflicts": conflicts,
    }


def update_journals(journals: DataFrame, changes: DataFrame, now: Column | None = None) -> DataFrame:
    """journals with the columns of changes, which has id, replaced where it names them; updated_at tells when, even if nothing differs."""
    columns = [c for c in changes.columns if c != "id"]
    if lost := set(columns) - set(journals.columns) | {"created_at", "updated_at"} & set(columns):
        raise ValueError(f"no columns to change: {sorted(lost)}")
    return state.update_by_key(journals, changes, ["id"], columns, now if now is not None else F.current_timestamp(), "updated_at")


def collided_source_ids(records: DataFrame, identifiers: DataFrame) -> DataFrame:
    """Source ids without an identifier of their own: what a repair would have to split off. Empty if the seed went by source id."""
    own = identifiers.where("identifier_type = 'SCIMAGO_SOURCE_ID'").select(F.col("normalized_value").alias("_own"))
    return records.select(S.strip("sourceid").alias("sourceid")).distinct().join(own, F.col("sourceid") == F.col("_own"), "left_anti")


def repair(records: DataFrame, journals: DataFrame, identifiers: DataFrame, now: Column | None = None) -> dict[str, DataFrame]:
    """Journals and links for the collided source ids alone; everything else stays as it is."""
    bad = collided_source_ids(records, identifiers)
    affected = records.join(bad, "sourceid", "left_semi")
    return seed(affected, journals.agg(F.max("id")).first()[0] or 0, identifiers, now)


def conflict_rows(conflicts: DataFrame, ids: DataFrame) -> DataFrame:
    """identifier_conflicts of a seed: each claimed identifier with its owner's journal and those of the source ids that claimed it too.

    conflicts as of seed(); ids has sourceid and journal_id.
    """
    claims = conflicts.select(F.col("normalized_value").alias("identifier"), "sourceid").unionByName(conflicts.where("owner is not null").select(F.col("normalized_value").alias("identifier"), F.col("owner").alias("sourceid")))
    found = claims.distinct().join(ids, "sourceid").groupBy("identifier").agg(F.array_sort(F.collect_set("journal_id")).alias("journal_ids"))
    return schemas.conform(found.withColumns({"source_id": F.lit(schemas.SOURCE_IDS["SCIMAGO"]), "source_record_table": F.lit(TABLE)}), "identifier_conflicts")


def require_invariants(tables: dict[str, DataFrame]) -> None:
    """An error that names what a seed's or a repair's tables break, if they break anything."""
    found = invariants(*(tables[t] for t in (TABLE, "journals", "journal_identifiers", "journal_source_mapping", "entity_match_decisions"))).where("violations > 0")
    if bad := found.collect():
        raise ValueError(f"after the change: {[(r.invariant, r.violations) for r in bad]}")


def repaired_tables(store, now: Column | None = None) -> dict[str, DataFrame]:
    """All of the tables that a repair changes, old rows and new ones, after the invariants are tested; empty if nothing has collided.

    The affected records get journals of their own; their mappings and decisions are replaced, other rows stay.
    """
    old = {name: store.read(name) for name in (TABLE, "journals", "journal_identifiers", "journal_aliases", "journal_source_mapping", "entity_match_decisions")}
    if collided_source_ids(old[TABLE], old["journal_identifiers"]).isEmpty():
        return {}
    made = repair(old[TABLE], old["journals"], old["journal_identifiers"], now)
    made.pop("conflicts")
    made = {name: state.durable(df) for name, df in made.items()}
    ids = made[TABLE].select("id")
    refs = ids.select(F.lit(TABLE).alias("source_record_table"), F.col("id").alias("source_record_id"))
    out = {TABLE: old[TABLE].join(ids, "id", "left_anti").unionByName(made[TABLE])}
    for name in ("journal_source_mapping", "entity_match_decisions"):
        out[name] = old[name].join(refs, ["source_record_table", "source_record_id"], "left_anti").unionByName(made[name])
    for name in ("journals", "journal_identifiers", "journal_aliases"):
        out[name] = old[name].unionByName(made[name])
    require_invariants(out)
    return out


def invariants(records: DataFrame, journals: DataFrame, identifiers: DataFrame, mapping: DataFrame, decisions: DataFrame) -> DataFrame:
    """(invariant, violations) that hold after a seed or a repair. Records are read once for their counts, and once against the identifiers."""
    own = identifiers.where("identifier_type = 'SCIMAGO_SOURCE_ID'").select(S.strip("normalized_value").alias("sourceid"), F.col("journal_id").alias("named"))
    groups = records.groupBy("sourceid", "journal_id").agg(F.count("*").alias("n"))
    each = groups.groupBy("sourceid").agg(F.count("journal_id").alias("journals"), F.sum("n").alias("n"), F.sum(F.when(F.col("journal_id").isNull(), F.col("n")).otherwise(0)).alias("open"))
    counted = each.agg(F.count("*").alias("ids"), F.count(F.when(F.col("journals") != 1, 1)).alias("split"), F.sum("n").alias("records"), F.sum("open").alias("open"))
    wrong = groups.join(own, "sourceid").where("not (journal_id <=> named)").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("wrong"))
    tagged = lambda df, kind: df.select(F.lit(kind).alias("kind"), (F.col("source_record_table") == TABLE).alias("ours") if "source_record_table" in df.columns else F.lit(True).alias("ours"))
    rows = tagged(own, "own").unionByName(tagged(journals, "journals")).unionByName(tagged(mapping, "mapping")).unionByName(tagged(decisions, "decisions"))
    sizes = {r.kind: r.n for r in rows.where("ours").groupBy("kind").agg(F.count("*").alias("n")).collect()}
    of, lost = counted.first(), wrong.first().wrong
    size, total = (lambda kind: sizes.get(kind, 0)), of.records or 0
    found = {
        "one identifier a source id": abs(size("own") - of.ids),
        "one journal a source id": of.split,
        "records agree with identifiers": lost,
        "every record linked": of.open or 0,
        "a mapping and a decision a record": abs(size("mapping") - total) + abs(size("decisions") - total),
        "journals cover the source ids": max(0, of.ids - size("journals")),
    }
    return records.sparkSession.createDataFrame(list(found.items()), "invariant string, violations long")
