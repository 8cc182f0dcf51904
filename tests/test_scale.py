import random

import pytest
from pyspark.sql import functions as F

from folioforge import schemas
from folioforge.operators import canonical, checks, ingest, state



def test_first_rows_of_a_hot_key(spark):
    """Half of all rows repeat one key, and a number may be there twice: the same as numbering each key's rows."""
    rng = random.Random(1)
    rows = [("f" if k % 3 else "g", k, "hot" if k % 2 else f"h{rng.randrange(40)}", 2026, "{}", ["bad"] if k % 17 == 0 else []) for k in range(600)]
    rows += [r for r in rows if r[1] in (1, 2, 5)]
    records = spark.createDataFrame(rows, "_file string, _row_number long, source_row_hash string, ft50_year int, raw_json string, problems array<string>")
    valid, rejected, repeats = ingest.split_records(records, "FT50")
    first, again = {}, []
    for f, n, h, *_ in sorted(r for r in rows if not r[5]):
        again.append((f, n)) if (f, h) in first else first.setdefault((f, h), n)
    assert sorted((r._file, r.source_row_hash, r._row_number) for r in valid.collect()) == sorted((f, h, n) for (f, h), n in first.items())
    assert sorted((r._file, r._row_number) for r in repeats.collect()) == sorted(again) and rejected.count() == sum(bool(r[5]) for r in rows)


def test_a_hot_key_can_be_split(spark):
    """The join that follows the aggregation has an exchange on either side, so a skewed key is split when it runs."""
    rows = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("h"), F.col("id") % 5000)).alias("k"), F.col("id").alias("v"), F.repeat(F.lit("x"), 40).alias("pad"))
    first = rows.groupBy("k").agg(F.min("v").alias("first"))
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = state.join_one(rows, first, "k")
        sizes = [r.n for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(sizes) == 200_000 and max(sizes) < 60_000


def test_owners_of_a_frequent_identifier(spark):
    rng = random.Random(2)
    rows = [(k, f"s{rng.randrange(30):02}", rng.choice([None, 2000, 2001, 2002]), rng.choice("ab"), rng.choice(["0378-5955", "0378-5955, 03178471", "bad", "2434-561x, 03785955"])) for k in range(300)]
    records = spark.createDataFrame(rows, "id long, sourceid string, year int, subject_area string, issn_raw string")
    owned, conflicts = canonical.issn_owners(records)
    seen = {}
    for k, s, y, a, raw in sorted(rows, key=lambda r: (-(r[2] or 0), r[3], r[0])):
        for part in raw.split(","):
            if (v := part.strip().replace("-", "").upper()) != "BAD":
                seen.setdefault((s, v), part.strip())
    owner = {}
    for s, v in sorted(seen):
        owner.setdefault(v, s)
    assert {(r.sourceid, r.normalized_value, r.identifier_value) for r in owned.collect()} == {(s, v, x) for (s, v), x in seen.items() if owner[v] == s}
    assert {(r.sourceid, r.normalized_value, r.owner) for r in conflicts.collect()} == {(s, v, owner[v]) for s, v in seen if owner[v] != s}


def test_lineage_by_bits(spark):
    """Ids far apart, records of rows that are nowhere or of another dataset's, rejected rows with a record, datasets without rows."""
    rng = random.Random(3)
    raw = [(rng.randrange(200_000), f, n) for f in (1, 2, 3) for n in range(120)]
    raw = [(k, f, n) for k, (f, n) in {k: (f, n) for k, f, n in raw}.items()]
    made = [(f, k) for k, f, n in raw if n % 3] + [(f, k) for k, f, n in raw if n % 10 == 1] + [(1, 999_999), (2, next(k for k, f, n in raw if f == 3 and n == 0))]
    bad = [(f, f, n) for _, f, n in raw if n % 4 == 0 for _ in range(2)] + [(1, 1, 5000)]
    datasets = spark.createDataFrame([(k, 5, "loaded" if k != 5 else "failed") for k in (1, 2, 3, 4, 5)], "id long, source_id int, status string")
    files = spark.createDataFrame([(k, k) for k in (1, 2, 3)], "id long, dataset_id long")
    frame = lambda rows, names: spark.createDataFrame(rows, names)
    report = checks.lineage(datasets, frame(raw, "id long, raw_file_id long, row_number long").withColumn("raw_data", F.lit("")), files, frame(bad, "dataset_id long, raw_file_id long, row_number long"), {"FT50": frame(made, "dataset_id long, raw_row_id long")})
    wanted, with_record, places = {}, {k for _, k in made}, {(f, n) for f, _, n in bad}
    for d in (1, 2, 3, 4):
        own = [(k, n) for k, f, n in raw if f == d]
        wanted[d] = (len(own), sum(1 for f, _ in made if f == d), len({k for f, k in made if f == d}), sum((d, n) in places and k not in with_record for k, n in own), sum((d, n) not in places and k not in with_record for k, n in own))
    assert {r.dataset_id: (r.raw_rows, r.normalized_records, r.distinct_source_rows, r.ingestion_rejections, r.skipped_rows) for r in report.collect()} == wanted


def test_constraints(spark, tmp_path):
    """Every kind of rule is named with its rows; publishing an unsound part names them and leaves nothing."""
    rows = [(1, 1, "accepted", 5), (1, 2, "accepted", 6), (2, 1, "odd", 7), (2, 1, None, 7), (3, 1, "odd", 8)]
    df = schemas.conform(spark.createDataFrame(rows, "source_record_id long, candidate_journal_id long, review_status string, id long").withColumns({"source_id": F.lit(2), "source_record_table": F.lit("t")}), "entity_match_candidates")
    found = {(r.constraint, r.detail, r.n) for r in schemas.violations(df, "entity_match_candidates").collect()}
    assert found == {
        ("unique(id)", '{"id":7}', 2), ("domain(review_status)", "odd", 2), ("one accepted candidate a record", '{"source_id":2,"source_record_table":"t","source_record_id":1}', 2),
        ("unique(source_id, source_record_table, source_record_id, candidate_journal_id)", '{"source_id":2,"source_record_table":"t","source_record_id":2,"candidate_journal_id":1}', 2),
    }
    store = state.Store(spark, str(tmp_path / "store"))
    for bad, name in ((df, "domain"), (df.where("review_status is null or review_status = 'accepted'"), "one accepted"), (df.where("id = 7").withColumn("review_status", F.lit("pending")), "unique")):
        with pytest.raises(ValueError, match=name):
            store.publish({"entity_match_candidates": bad})
    assert store.version() == 0 and store.publish({"entity_match_candidates": df.limit(0), "journals": schemas.empty(spark, "journals")}) == 1
    with pytest.raises(Exception, match="changed twice"):
        state.update_by_key(df, df.where("id = 7").select("id", "review_status"), ["id"], ["review_status"]).collect()


def test_invariants_find_what_is_broken(spark):
    """Each invariant broken by itself, and counted."""
    records = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 3), (4, "c", None), (5, "c", 9)], "id long, sourceid string, journal_id long")
    identifiers = spark.createDataFrame([("SCIMAGO_SOURCE_ID", "a", 1), ("ISSN", "x", 1)], "identifier_type string, normalized_value string, journal_id long")
    journals = spark.createDataFrame([(1,)], "id long")
    refs = spark.createDataFrame([("scimago_records", k) for k in range(4)] + [("other", 9)], "source_record_table string, source_record_id long")
    found = {r.invariant: r.violations for r in canonical.invariants(records, journals, identifiers, refs, refs.limit(0)).collect()}
    assert found == {"one identifier a source id": 2, "one journal a source id": 1, "records agree with identifiers": 1, "every record linked": 1, "a mapping and a decision a record": 1 + 5, "journals cover the source ids": 2}


def test_current_rows_are_merged(spark):
    """After every import and reset the merged rows are those of all records; records of other journals aren't read."""
    from folioforge.plans import views

    rng, schema = random.Random(4), "id long, journal_id long, subject_area string, year int, sjr double, dataset_id long"
    make = lambda ids, dataset: [(k, rng.choice([None, *range(12)]), rng.choice("AB"), rng.choice([None, 2019, 2020, 2021]), rng.choice([None, 1.0, 2.0]), dataset) for k in ids]
    frame = lambda rows: spark.createDataFrame(rows, schema)
    rows = make(range(100), 1)
    kept = views.current(frame(rows), "SCIMAGO")
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))
    for dataset in range(2, 5):
        added = make(range(100 * dataset, 100 * dataset + 60), dataset)
        gone = [r for r in rows if r[5] == dataset - 2]
        left = [r for r in rows if r[5] != dataset - 2]
        if gone:
            touched = {r[1] for r in gone}
            kept = state.durable(views.merged_current(kept, "SCIMAGO", frame(added), frame(gone), frame([r for r in left if r[1] in touched])))
        else:
            kept = state.durable(views.merged_current(kept, "SCIMAGO", frame(added)))
        rows = left + added
        assert same(kept, views.current(frame(rows), "SCIMAGO"))
    with pytest.raises(ValueError):
        views.merged_current(kept, "SCIMAGO", kept, kept)
