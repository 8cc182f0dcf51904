"""Command line: python -m folioforge STORE COMMAND ...; see --help."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from . import schemas
from .operators import canonical, checks, ingest, resolve, review, state
from .plans import views
from .session import session
from .sources import delimited, tables


def _ingest(store: state.Store, args) -> None:
    paths = [args.path] if args.path.lower().endswith((".csv", ".xlsx")) else delimited.discover(store.spark, args.path)
    said = ingest.import_files(store, args.source, paths) if paths else {}
    for path, outcome in said.items():
        print(f"{path}: {outcome}")
    if any(x.startswith("failed") for x in said.values()):
        raise SystemExit(1)


def _seed(store: state.Store, args) -> None:
    records = store.read("scimago_records")
    if args.limit_sourceids:
        records = canonical.first_source_ids(records, args.limit_sourceids)
    made = canonical.seed(records, store.read("journals").agg(F.max("id")).first()[0] or 0, store.read("journal_identifiers"))
    conflicts = made.pop("conflicts")
    print(f"journals: {made['journals'].count()}, identifier conflicts: {conflicts.count()}")
    if args.dry_run:
        return
    if args.limit_sourceids or store.read("journals").limit(1).count():
        raise SystemExit("only an empty store is seeded, and whole; use --dry-run to try a part")
    canonical.require_invariants(made)
    rows = canonical.conflict_rows(conflicts, made["scimago_records"].select("sourceid", "journal_id").distinct())
    store.publish(made | {"identifier_conflicts": rows})


def _repair(store: state.Store, args) -> None:
    changed = canonical.repaired_tables(store, F.current_timestamp())
    if changed:
        store.publish(changed)
    print(f"tables changed: {len(changed)}")


def _resolve(store: state.Store, args) -> None:
    if args.source:
        store.publish(resolve.resolve_source(store, args.source))
        found = {args.source: "resolved"}
    else:
        found = resolve.resolve_all(store)
    for source, result in found.items():
        print(f"{source}: {result}")
    if any(r.startswith("failed") for r in found.values()):
        raise SystemExit(1)


def _apply(store: state.Store, args) -> None:
    changed, stale = review.apply_decisions(store, delimited.read_review_csv(store.spark, args.path), args.reviewer)
    stale = stale.persist()
    store.publish(changed)
    if args.stale_report:
        state.write_report(stale, args.stale_report)
    print(f"stale rows: {stale.count()}")


def _check(store: state.Store, args) -> None:
    r = store.read
    if args.kind == "history":
        report = checks.history_gaps(r("scimago_records"), "journal_id", "year", r("journals").select(F.col("id").alias("journal_id"), "canonical_title"))
    elif args.kind == "duplicates":
        report = None
        for name in schemas.TABLES:
            part = schemas.violations(r(name), name).withColumn("table", F.lit(name))
            report = part if report is None else report.unionByName(part)
    elif args.kind == "conflicts":
        listed = delimited.read_conflict_csv(store.spark, args.conflicts).select("identifier", "journal_ids") if args.conflicts else r("identifier_conflicts").select("identifier", "journal_ids")
        report = checks.open_conflicts(listed, r("entity_match_candidates"))
    elif args.kind == "failures":
        report = r("resolution_failures")
    elif args.kind == "drift":
        titles = r("journals").select(F.col("id").alias("journal_id"), "normalized_title")
        report = checks.match_drift(checks.drift_sample(r("entity_match_candidates"), review.display_names(store)), titles)
    elif args.kind == "dangling":
        report = checks.dangling(r("journal_source_mapping").select("source_id", "source_record_table", "source_record_id", "journal_id"), {t: r(t) for t in schemas.RECORD_TABLES.values()})
    elif args.kind == "lineage":
        report = checks.lineage(r("datasets"), r("raw_rows"), r("raw_files"), r("ingestion_rejections"), {s: r(t) for s, t in schemas.RECORD_TABLES.items()})
    else:
        report = checks.coverage_of(store)
        print(checks.coverage_text(report, r("journals").count()), end="")
    report = report.persist()
    state.write_report(report, args.out)
    print(f"rows: {report.count()}")
    if args.kind == "lineage" and report.where("status = 'FAIL'").limit(1).count():
        raise SystemExit("a dataset's rows don't add up")


def _sql(store: state.Store, args) -> None:
    for name in schemas.TABLES:
        store.read(name).createOrReplaceTempView(name)
    views.register(store)
    store.spark.sql(args.query).show(args.rows, truncate=False)


def _pull(store: state.Store, args) -> None:
    properties = dict(x.split("=", 1) for x in args.option)
    for name, n in tables.pull(store, args.url, args.tables, **properties).items():
        print(f"{name}: {n}")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser("folioforge")
    out.add_argument("store", help="folder of the versioned tables")
    commands = out.add_subparsers(dest="command", required=True)

    def command(name: str, run, **arguments) -> None:
        sub = commands.add_parser(name)
        sub.set_defaults(run=run)
        for key, options in arguments.items():
            sub.add_argument(key if not options.pop("flag", False) else f"--{key.replace('_', '-')}", **options)

    command("ingest", _ingest, source={"choices": sorted(schemas.SOURCE_IDS)}, path={})
    command("seed", _seed, limit_sourceids={"flag": True, "type": int, "default": 0}, dry_run={"flag": True, "action": "store_true"})
    command("repair", _repair)
    command("vacuum", lambda store, args: print(f"folders removed: {store.vacuum()}"))
    command("resolve", _resolve, source={"nargs": "?", "choices": resolve.ORDER})
    command("export-review", lambda store, args: print(f"rows: {review.export_pending(store, args.path)}"), path={})
    command("apply-review", _apply, path={}, reviewer={"flag": True, "required": True}, stale_report={"flag": True})
    command("check", _check, kind={"choices": ["history", "duplicates", "drift", "dangling", "lineage", "coverage", "conflicts", "failures"]}, out={}, conflicts={"flag": True})
    command("reset", lambda store, args: print(f"version {ingest.reset_dataset(store, args.dataset, args.table)}"), dataset={"type": int}, table={"choices": sorted(schemas.RECORD_TABLES.values())})
    command("pull", _pull, url={}, tables={"nargs": "*"}, option={"flag": True, "action": "append", "default": [], "metavar": "NAME=VALUE"})
    command("sql", _sql, query={}, rows={"flag": True, "type": int, "default": 100})
    return out


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(state.Store(session(), args.store), args)


if __name__ == "__main__":
    main(sys.argv[1:])
