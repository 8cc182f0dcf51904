import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from folioforge import schemas
from folioforge.functions.similarity import common_length
from folioforge.operators import candidates as C
from folioforge.operators import canonical, checks, resolve, state
from folioforge.plans import views


def one_by_one(records, journals, identifiers, first_new):
    """The ladder, record after record, with plain loops."""
    titles, owners, out = dict(journals), {}, {}
    for journal, value in identifiers:
        owners.setdefault(value, set()).add(journal)

    def score(a, b):
        a, b = (" ".join(sorted(x.split())) for x in (a, b))
        return Fraction(2 * common_length(a, b), len(a) + len(b))

    for k, key, issns in sorted(records):
        hits = set().union(*(owners[v] for v in issns if len(owners.get(v, ())) == 1)) if issns else set()
        exact = sorted(j for j, t in titles.items() if t == key)
        near = sorted((-score(key, t), j) for j, t in titles.items() if t[:4] == key[:4] and score(key, t) >= Fraction(9, 10))[:5]
        if len(hits) == 1:
            out[k] = (hits.pop(), "exact_issn", "accepted")
        elif len(exact) == 1:
            out[k] = (exact[0], "exact_title", "accepted")
        elif near:
            best = round(float(-near[0][0]) + 1e-12, 4)
            method = ("exact_title_ambiguous+" if near[0][1] in exact else "") + "fuzzy_title"
            out[k] = (near[0][1], method, "accepted") if best >= 0.97 else (None, method, "pending")
        else:
            titles[first_new] = key
            for v in issns:
                owners.setdefault(v, {first_new})
            out[k] = (first_new, "new_journal", "new_journal")
            first_new += 1
    return out


@pytest.mark.parametrize("seed", range(3))
def test_rounds_equal_the_sequence(spark, seed):
    rng = random.Random(seed)
    base = ["journal of market research", "journal of market researches", "journal of public market", "review of law", "reviews of law", "economic letters and notes in theory"]
    keys = base + [b + x for b in base for x in ("", "s", " ii")]
    journals = [(k, rng.choice(keys)) for k in range(1, 5)]
    identifiers = [(1, "A"), (2, "B")]
    records = [(k, rng.choice(keys), rng.sample("ABCDEF", rng.choice([0, 0, 1, 1, 2]))) for k in rng.sample(range(10, 60), 12)]
    df = spark.createDataFrame(records, "id long, key string, issns array<string>")
    dim = spark.createDataFrame(journals, "id long, normalized_title string")
    ids = spark.createDataFrame([(j, "ISSN", v) for j, v in identifiers], "journal_id long, identifier_type string, normalized_value string")
    found = {r.id: (r.journal_id, r.match_method, r.outcome) for r in resolve.resolve_records(df, dim, ids, 100).outcomes.collect()}
    assert found == one_by_one(records, journals, identifiers, 100)


def test_thresholds(spark):
    titles = spark.createDataFrame([("abcdefghij",)], "key string")
    with pytest.raises(ValueError):
        resolve.similar_titles(titles, titles.withColumnRenamed("key", "other"), 1100)
    with pytest.raises(ValueError):
        resolve.fuzzy_titles(titles.withColumn("id", F.lit(1)), titles.select(F.col("key").alias("normalized_title"), F.lit(1).alias("journal_id")), top=0)
    pairs = resolve.prefix_titles(spark.createDataFrame([("ab",), ("abcd x",)], "key string"), spark.createDataFrame([("abcd x",), ("abz",)], "other string"))
    assert {(r.key, r.other) for r in pairs.collect()} == {("ab", "abcd x"), ("ab", "abz"), ("abcd x", "abcd x")}


def test_identifier_conflicts(spark):
    dim = spark.createDataFrame([(1, "A"), (2, "A"), (2, "B"), (3, "C")], "journal_id long, normalized_value string")
    records = spark.createDataFrame([(1, ["A"]), (2, ["A", "B"]), (3, ["B", "C"]), (4, []), (5, ["C"])], "id long, issns array<string>")
    matches, conflicts = resolve.by_identifier(records, dim)
    assert {r.id: r.journal_id for r in matches.collect()} == {2: 2, 5: 3}
    assert [tuple(r) for r in conflicts.collect()] == [("A", [1, 2])]


def test_method_merge(spark):
    cases = {("a", "a"): "a", (None, "b"): "b", ("a", None): "a", ("ab", "a"): "ab", ("a", "ab"): "ab", ("x", "y"): "x+y", ("fuzzy_title", "fuzzy_title_raw"): "fuzzy_title_raw"}
    df = spark.createDataFrame(list(cases), "o string, n string").select("o", "n", C.merge_methods(F.col("o"), F.col("n")).alias("m"))
    assert {(r.o, r.n): r.m for r in df.collect()} == cases


def queue(spark, rows):
    return schemas.conform(spark.createDataFrame(rows, "id long, source_record_id long, candidate_journal_id long, similarity double, match_method string, rank_among_candidates int, review_status string").withColumns({"source_id": F.lit(2), "source_record_table": F.lit("t"), "issn_match": F.lit(False)}), "entity_match_candidates")


def test_upsert_and_close(spark):
    old = queue(spark, [(1, 1, 1, 0.9, "fuzzy_title", 2, "pending"), (2, 1, 2, 0.5, "x", 1, "accepted")])
    new = C.fold(queue(spark, [(None, 1, 1, 0.95, "exact_title_ambiguous", 1, None), (None, 1, 2, 0.99, "y", 1, None), (None, 3, 1, 0.91, "z", 1, None)]).withColumn("seq", F.lit(1)))
    found = {(r.source_record_id, r.candidate_journal_id): r for r in C.upsert(old, new).collect()}
    merged = found[1, 1]
    assert (float(merged.similarity), merged.match_method, merged.rank_among_candidates, merged.review_status) == (0.95, "fuzzy_title+exact_title_ambiguous", 1, "pending")
    assert float(found[1, 2].similarity) == 0.5 and found[1, 2].review_status == "accepted" and found[3, 1].id is None and found[3, 1].review_status == "pending"
    many = queue(spark, [(1, 1, 1, 0.9, "f", 1, "pending"), (2, 1, 2, 0.8, "f", 2, "pending"), (3, 2, 1, 0.8, "f", 1, "rejected"), (4, 2, 2, 0.7, "f", 2, "pending")])
    assert {r.id for r in C.best(many).collect()} == {1, 4}
    closed = {r.id: r.review_status for r in C.accept_and_close(many, many.where("id = 1")).collect()}
    assert closed == {1: "accepted", 2: "rejected", 3: "rejected", 4: "pending"}
    again = C.accept_and_close(C.accept_and_close(many, many.where("id = 1")), many.where("id = 1"))
    assert {r.id: r.review_status for r in again.collect()} == closed
    with pytest.raises(Exception, match="rejected candidate"):
        C.accept_and_close(many, many.where("id = 3")).collect()


def scimago(spark, rows):
    return schemas.conform(spark.createDataFrame(rows, "id long, sourceid string, year int, subject_area string, title string, issn_raw string, publisher_raw string"), "scimago_records")


def test_seed(spark):
    records = scimago(
        spark,
        [(1, "20", 2019, "Arts", "Old  Name", "0378-5955", "P"), (2, "20", 2020, "arts", "New Name", "03178471, 03785955", " "), (3, "20", 2020, "Biz", "New Name", None, "Q"), (4, "10", 2018, "Arts", "The Other", "03178471", None), (5, "10", 2018, "Arts", "The Other", "bad", None)],
    )
    found = canonical.seed(records, 100)
    journals = {r.id: r for r in found["journals"].collect()}
    assert {k: (r.canonical_title, r.normalized_title, r.publisher, r.first_observed_year) for k, r in journals.items()} == {101: ("The Other", "other", None, 2018), 102: ("New Name", "new name", "Q", 2019)}
    names = {(r.identifier_type, r.normalized_value): r.journal_id for r in found["journal_identifiers"].collect()}
    assert names == {("SCIMAGO_SOURCE_ID", "10"): 101, ("SCIMAGO_SOURCE_ID", "20"): 102, ("ISSN", "03178471"): 101, ("ISSN", "03785955"): 102}
    assert [(r.sourceid, r.normalized_value, r.owner) for r in found["conflicts"].collect()] == [("20", "03178471", "10")]
    assert [(r.journal_id, r.alias_name) for r in found["journal_aliases"].collect()] == [(102, "Old Name")]
    assert found["scimago_records"].where("journal_id is null").count() == 0 and found["journal_source_mapping"].count() == 5
    assert canonical.collided_source_ids(records, found["journal_identifiers"].where("normalized_value <> '10'")).first().sourceid == "10"
    assert canonical.repair(records, found["journals"], found["journal_identifiers"].where("normalized_value <> '10'"))["journals"].first().id == 103
    with pytest.raises(Exception, match="no usable title"):
        canonical.seed(scimago(spark, [(1, "1", 2019, "A", " ", None, None)]))["journals"].collect()


def test_views(spark):
    journals = spark.createDataFrame([(1, "One", "P"), (2, "Two", None)], "id long, canonical_title string, publisher string")
    records = spark.createDataFrame([(1, 1, "A", 2019, 2.0, "Q2", 5), (2, 1, "A", 2020, None, "Q1", 5), (3, 1, "A", 2020, 1.0, "Q2", 6), (4, 1, "B", 2018, 9.0, "Q2", 7), (5, None, "B", 2020, 9.0, "Q1", 7)], "id long, journal_id long, subject_area string, year int, sjr double, sjr_best_quartile string, h_index int")
    assert {(r.subject_area, r.scimago_record_id) for r in views.scimago_latest(records).collect()} == {("A", 3), ("B", 4)}
    abdc = spark.createDataFrame([(1, 1, 2022, "B", "f", "s", 1), (2, 1, 2025, "A", "f", "s", 1)], "id long, journal_id long, rating_year int, rating string, for_code string, for_scheme string, dataset_id long")
    ft50 = spark.createDataFrame([(2,), (None,)], "journal_id long")
    found = {r.journal_id: r for r in views.journal_summary(journals, records, abdc, ft50).collect()}
    assert (found[1].scimago_current_sjr, found[1].scimago_current_quartile, found[1].abdc_current_rating, found[1].in_ft50) == (9.0, "Q2", "A", False)
    assert (found[2].scimago_current_sjr, found[2].abdc_current_rating, found[2].in_ft50) == (None, None, True)


def test_checks(spark):
    years = spark.createDataFrame([(1, 2000), (1, 2002), (1, 2003), (1, 2006), (2, 2000), (2, 2001), (2, 2002), (None, 2000)], "journal_id long, year int")
    assert [tuple(r) for r in checks.history_gaps(years, "journal_id", "year").collect()] == [(1, 2001, 2000, 2002)]
    refs = spark.createDataFrame([("a", 1), ("a", 9), ("z", 1)], "source_record_table string, source_record_id long")
    lost = {(r.source_record_table, r.source_record_id): r.reason for r in checks.dangling(refs, {"a": spark.createDataFrame([(1,)], "id long")}).collect()}
    assert lost == {("a", 9): "source_record_missing", ("z", 1): "unknown_source_table"}
    conflicts = spark.createDataFrame([("X", [1, 2])], "identifier string, journal_ids array<long>")
    open_ = checks.open_conflicts(conflicts, queue(spark, [(1, 1, 2, 0.9, "f", 1, "pending")]))
    assert [r.candidate_journal_id for r in open_.collect()] == [2]
    titles = spark.createDataFrame([(1, "alpha beta"), (2, "alpha betas")], "journal_id long, normalized_title string")
    accepted = spark.createDataFrame([("t", 1, 1, 1.0, "alpha beta"), ("t", 2, 1, 1.0, "alpha betas"), ("t", 3, 1, 1.0, "alpha bet xyz")], "source_record_table string, source_record_id long, journal_id long, s double, key string").select("source_record_table", "source_record_id", "journal_id", F.col("s").cast("decimal(5,4)").alias("accepted_score"), F.lit(None).cast("timestamp").alias("accepted_at"), "key")
    assert {r.source_record_id: r.reason for r in checks.match_drift(accepted, titles).collect()} == {2: "not_recomputable", 3: "score_drop"}


def test_ids_and_updates(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 500).alias("k")).repartition(7)
    assert {r.id - 10 - r.k for r in state.next_ids(df, ["k"], 10).collect()} == {1}
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, t int")
    new = spark.createDataFrame([(2, None)], "k int, v string")
    assert sorted(map(tuple, state.update_by_key(old, new, ["k"], ["v"], F.lit(9), "t").collect())) == [(1, "a", 0), (2, None, 9)]
    with pytest.raises(ValueError):
        state.require_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"], "twice")


@pytest.mark.parametrize("source", resolve.ORDER)
def test_records_without_a_usable_title_stay_open(spark, source):
    """They make no journal and are listed; the others of their source are resolved."""
    name = resolve.COLUMNS[source][0]
    records = spark.createDataFrame([(1, "..."), (2, "Alpha Review"), (3, "!!"), (4, None), (5, "alpha review")], f"id long, {name} string")
    table = schemas.RECORD_TABLES[source]
    changed = resolve.resolve_source(state.Frames(spark, **{table: records}), source)
    assert [(r.id, r.normalized_title) for r in changed["journals"].collect()] == [(1, "alpha review")]
    assert {r.id: r.journal_id for r in changed[table].collect()} == {1: None, 2: 1, 3: None, 4: None, 5: 1}
    assert {(r.source_record_id, r.reason) for r in changed["resolution_failures"].collect()} == {(k, "no_usable_title") for k in (1, 3, 4)}
    assert changed["entity_match_decisions"].count() == 2


def test_conflicts_are_kept(spark):
    records = spark.createDataFrame([(1, "Alpha", "0378-5955")], "id long, journal_name string, issn string")
    ids = spark.createDataFrame([(1, "ISSN", "03785955"), (2, "EISSN", "03785955")], "journal_id long, identifier_type string, normalized_value string")
    changed = resolve.resolve_source(state.Frames(spark, abdc_records=records, journal_identifiers=ids, journals=spark.createDataFrame([(1, "x", "xx"), (2, "y", "yy")], "id long, canonical_title string, normalized_title string")), "ABDC")
    assert [(r.identifier, r.journal_ids, r.source_record_table) for r in changed["identifier_conflicts"].collect()] == [("03785955", [1, 2], "abdc_records")]
    seeded = canonical.seed(scimago(spark, [(1, "10", 2018, "A", "One", "03178471", None), (2, "20", 2018, "A", "Two", "03178471", None)]))
    rows = canonical.conflict_rows(seeded["conflicts"], seeded["scimago_records"].select("sourceid", "journal_id").distinct())
    assert [(r.identifier, r.journal_ids) for r in rows.collect()] == [("03178471", [1, 2])]


def test_appended_rows_are_a_part_of_their_own(spark, tmp_path):
    """The older rows' files aren't written again; keys are checked against them; vacuum removes what no version names."""
    store = state.Store(spark, str(tmp_path / "store"))
    row = lambda k, n=1: spark.createDataFrame([(k, n, "r")], "id long, raw_file_id long, raw_data string").withColumn("row_number", F.col("id"))
    store.publish({"raw_rows": row(1)})
    first = {p: p.stat().st_mtime_ns for p in (tmp_path / "store/versions/1").rglob("*.parquet")}
    store.publish({}, append={"raw_rows": row(2)})
    assert sorted(r.id for r in store.read("raw_rows").collect()) == [1, 2]
    assert first == {p: p.stat().st_mtime_ns for p in (tmp_path / "store/versions/1").rglob("*.parquet")}
    assert spark.read.parquet(str(tmp_path / "store/versions/2/raw_rows")).count() == 1
    with pytest.raises(ValueError, match="constraints"):
        store.publish({}, append={"raw_rows": row(1)})
    assert store.version() == 2
    store.publish({"raw_rows": store.read("raw_rows")})
    assert store.vacuum() == 2 and sorted(r.id for r in store.read("raw_rows").collect()) == [1, 2] and store.manifest() == {"raw_rows": [3]}
