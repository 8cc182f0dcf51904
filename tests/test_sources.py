import io
import zipfile

import pytest
from pyspark.sql import functions as F

from folioforge.operators import checks, ingest, review, state
from folioforge.operators import resolve as R
from folioforge.operators import transforms as T
from folioforge.plans import views
from folioforge.sources import delimited, inventory, workbook
from folioforge.streaming import ingest as streaming

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def make_book(sheets):
    """A workbook with shared and inline strings, numbers and rows that are left out."""
    out, shared = io.BytesIO(), []
    with zipfile.ZipFile(out, "w") as book:
        links, names = "", ""
        for n, (name, rows) in enumerate(sheets.items(), 1):
            body = ""
            for y, row in enumerate(rows, 1):
                if row is None:
                    continue
                cells = ""
                for x, v in enumerate(row):
                    ref = f"{chr(65 + x)}{y}"
                    if isinstance(v, int):
                        cells += f'<c r="{ref}"><v>{v}</v></c>'
                    elif v is not None and x % 2:
                        cells += f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
                    elif v is not None:
                        shared.append(v)
                        cells += f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>'
                body += f'<row r="{y}">{cells}</row>'
            book.writestr(f"xl/worksheets/sheet{n}.xml", f"<worksheet {MAIN}><sheetData>{body}</sheetData></worksheet>")
            links += f'<Relationship Id="r{n}" Target="worksheets/sheet{n}.xml"/>'
            names += f'<sheet name="{name}" r:id="r{n}"/>'
        book.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{names}</sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
        book.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{''.join(f'<si><t>{v}</t></si>' for v in shared)}</sst>")
    return out.getvalue()


BOOK = {
    name: [["Quality list", None, None, None], None, [title, "ISSN ", "ISSN Online", "Publisher", rating], [f"Journal of {name[:4]} Things", "0378-5955", None, "P", "a*"], None, ["Odd", None, None, "P", "c"], ["Blank", None, None, None, None]]
    for name, (_, _, rating) in workbook.SHEETS.items()
    for title in [("Journal Title" if name[:4] > "2015" else "Journal Name")]
}
SCIMAGO = 'Rank;Sourceid;Title;Type;Issn;SJR;SJR Best Quartile;H index;Total Docs. (2019);Citations / Doc. (2years);Ref. / Doc.;%Female;Publisher;Open Access;Open Access Diamond;Categories;Areas\n1;23571;Science;journal;"10959203, 00368075";13,110;Q1;1229;3085;11,78;12,90;30,18;AAAS;Yes;No;"History and Philosophy of Science (Q1); Multidisciplinary (Q1)";"Arts and Humanities; Multidisciplinary"\n2;77;Bad;journal;-;101,000;Q7;1;1;1;1;1;X;No;No;;\n3;78;Nil;journal;-;;-;1;1;1;1;1;;No;No;;\n'


@pytest.fixture
def raw(tmp_path):
    files = {
        "scimago/scimagojr 2019  Subject Area - Arts and Humanities.csv": SCIMAGO.encode(),
        "scimago/scimagojr_2019__x.csv": SCIMAGO.encode() + b"\n",
        "abdc.xlsx": make_book(BOOK),
        "abs.csv": "TITLE,FIELD,ISSN,PUBLISHER,AJG2024,AJG2021\nJournal of 2025 Things,F,0378-5955,P,4*,3\nÉtude,F,,P,,\nNew One,F,0317-8471,P,9,2\n".encode("latin-1"),
        "repec.csv": b'rank,journals,score,items_listed,simple_if,recursive_if,discounted_if,recursive_discounted_if,h_index,euclid\n1,"Econometrica, Econometric Society",1.5,3,1,1,1,1,9,2\n2,"Science",oops,3,1,1,1,1,9,2\n',
        "ft50.csv": b"rank,journal_name,ft50_year\n1,Science,2026\n2,Brand New,2026\n1,Science,2026\n",
    }
    for name, data in files.items():
        path = tmp_path / "raw" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    return tmp_path / "raw"


def test_file_names(spark):
    names = ["scimagojr 2019  Subject Area - Arts and Humanities.csv", "/x/scimagojr 2025  Subject Area - Business, Management and Accounting.csv", "scimagojr_2019__Subject_Area_-_Arts_and_Humanities.csv"]
    found = delimited.parse_file_name(F.col("n"))
    rows = spark.createDataFrame([(n,) for n in names], "n string").select(found["year"].alias("y"), found["subject_area"].alias("a")).collect()
    assert [(r.y, r.a) for r in rows] == [(2019, "Arts and Humanities"), (2025, "Business, Management and Accounting"), (None, None)]


def test_scimago_golden(spark, raw):
    path = delimited.discover(spark, str(raw / "scimago"))[0]
    records = {r.sourceid: r for r in T.validate_scimago(T.transform_scimago(delimited.read_scimago_csv(spark, path))).collect()}
    science = records["23571"]
    assert (float(science.sjr), float(science.citations_per_doc_2years), float(science.refs_per_doc), float(science.female_percentage)) == (13.11, 11.78, 12.9, 30.18)
    assert science.total_docs == 3085 and science.issn_list == ["10959203", "00368075"] and science.open_access and not science.open_access_diamond and science.year == 2019
    assert [tuple(c) for c in science.categories] == [("History and Philosophy of Science", "Q1"), ("Multidisciplinary", "Q1")] and science.areas == ["Arts and Humanities", "Multidisciplinary"]
    assert records["77"].problems == ["sjr_out_of_range"] and records["78"].problems == [] and records["78"].sjr is None


def test_header_discovery():
    rows = [["Journal Title"], ["x"], [" journal title ", "ISSN"]]
    assert workbook.find_header_row(rows, ["Journal Title"]) == 2
    assert workbook.find_header_row(rows, ["Journal Title"], two_signals=False) == 0
    with pytest.raises(ValueError):
        workbook.find_header_row(rows, ["Journal Title"], max_scan_rows=2)
    with pytest.raises(ValueError):
        workbook.find_header_row(rows, [])


def test_abdc(spark):
    df = workbook.read_abdc_sheet(spark, make_book(BOOK), "2010 JQL", "b.xlsx")
    rows = T.validate_abdc(T.transform_abdc(df, "2010 JQL")).orderBy("_row_number").collect()
    assert [(r.journal_name, r.rating, r.issn, r.rating_year, r.for_scheme, r.problems) for r in rows] == [("Journal of 2010 Things", "A*", "03785955", 2010, "ANZSRC2008", []), ("Odd", "C", None, 2010, "ANZSRC2008", []), ("Blank", None, None, 2010, "ANZSRC2008", [])]
    with pytest.raises(ValueError):
        T.transform_abdc(df, "1999 JQL")


def test_abdc_problems(spark):
    base = {"journal_name": "x", "source_row_hash": "0" * 64, "rating_year": 2025, "for_scheme": "ANZSRC2020", "rating": "A"}
    cases = [({}, []), ({"rating": None}, []), ({"rating": "D"}, ["invalid_rating"]), ({"rating_year": 2024}, ["invalid_rating_year"]), ({"for_scheme": "ANZSRC2015"}, ["invalid_for_scheme"]), ({"journal_name": None, "source_row_hash": "zz"}, ["journal_name_missing", "invalid_source_row_hash"])]
    for change, wanted in cases:
        row = base | change
        df = spark.createDataFrame([tuple(row.values())], "journal_name string, source_row_hash string, rating_year int, for_scheme string, rating string")
        assert T.validate_abdc(df).first().problems == wanted


def test_scimago_problems(spark):
    schema = "sourceid string, title string, sjr_value double, sjr_best_quartile string, sjr_out_of_range boolean"
    for row, wanted in {("1", "t", 0.0, "Q1"): [], ("1", "t", 100.0, None): [], ("1", "t", -0.001, None): ["sjr_out_of_range"], ("1", "t", 100.001, None): ["sjr_out_of_range"], ("1", "t", None, "Q5"): ["invalid_sjr_best_quartile"], (None, None, -1.0, "Q5"): ["sourceid_missing", "title_missing", "sjr_out_of_range", "invalid_sjr_best_quartile"]}.items():
        assert T.validate_scimago(spark.createDataFrame([(*row, False)], schema)).first().problems == wanted


def test_columns_are_checked(spark, tmp_path):
    (tmp_path / "a.csv").write_text("rank,name\n1,x\n")
    with pytest.raises(ValueError):
        delimited.read_ft50_csv(spark, str(tmp_path / "a.csv"))
    with pytest.raises(ValueError):
        T.unpivot_abs(spark.createDataFrame([("x", "f", 1)], "TITLE string, _file string, _row_number int"))
    with pytest.raises(ValueError):
        delimited.read_review_csv(spark, str(tmp_path / "a.csv"))


def test_sniffing(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a|b\n1|2\n3|4\n")
    assert delimited.load_csv(spark, str(tmp_path / "a.csv"), None).columns[:2] == ["a", "b"]
    assert delimited.detect_delimiter("plain") == ","


def test_inventory(spark, raw):
    rows = {(r.file_name, r.sheet_name): r for r in inventory.inventory(spark, [("ABS", str(raw / "abs.csv")), ("ABDC", str(raw / "abdc.xlsx"))]).collect()}
    assert rows["abs.csv", None].encoding == "latin-1" and rows["abs.csv", None].row_count == 3 and rows["abs.csv", None].identifier_status == "has_identifier"
    assert rows["abdc.xlsx", "2010 JQL"].header_row == 2 and rows["abdc.xlsx", "2010 JQL"].row_count == 3


def test_end_to_end(spark, raw, tmp_path):
    store = state.Store(spark, str(tmp_path / "store"))
    files = [("SCIMAGO", str(raw / "scimago/scimagojr 2019  Subject Area - Arts and Humanities.csv")), ("ABDC", str(raw / "abdc.xlsx")), ("ABS", str(raw / "abs.csv")), ("REPEC", str(raw / "repec.csv")), ("FT50", str(raw / "ft50.csv"))]
    assert [ingest.load_file(store, s, p) for s, p in files] == ["loaded"] * 5
    assert ingest.load_file(store, *files[4]) == "skipped"
    assert ingest.load_file(store, "SCIMAGO", str(raw / "scimago/scimagojr_2019__x.csv")) == "skipped"
    counts = {t: store.read(t).count() for t in ("scimago_records", "scimago_categories", "abdc_records", "abs_records", "repec_records", "ft50_records", "ingestion_rejections", "raw_rows", "raw_files")}
    assert counts == {"scimago_records": 2, "scimago_categories": 2, "abdc_records": 18, "abs_records": 3, "repec_records": 1, "ft50_records": 2, "ingestion_rejections": 3, "raw_rows": 3 + 18 + 3 + 2 + 3, "raw_files": 5}
    report = checks.lineage(store.read("datasets"), store.read("raw_rows"), store.read("raw_files"), store.read("ingestion_rejections"), {s: store.read(t) for s, t in ingest.schemas.RECORD_TABLES.items()})
    assert {r.source_code: r.status for r in report.collect()} == dict.fromkeys(ingest.schemas.SOURCE_IDS, "PASS")

    from folioforge.operators import canonical

    seeded = canonical.seed(store.read("scimago_records"))
    seeded.pop("conflicts")
    store.publish(seeded)
    assert canonical.invariants(*(store.read(t) for t in ("scimago_records", "journals", "journal_identifiers", "journal_source_mapping", "entity_match_decisions"))).where("violations > 0").count() == 0
    assert canonical.collided_source_ids(store.read("scimago_records"), store.read("journal_identifiers")).count() == 0
    assert set(R.resolve_all(store).values()) == {"resolved"}
    coverage = {r.source_code: r for r in checks.coverage_of(store).collect()}
    assert all(r.adds_up for r in coverage.values()) and coverage["SCIMAGO"].accepted == 2 and coverage["FT50"].accepted == 1 and coverage["FT50"].new_journal == 1
    assert checks.coverage_text(checks.coverage_of(store), 3).startswith("Coverage report")
    before = {t: store.read(t).count() for t in ("journals", "entity_match_decisions", "journal_source_mapping")}
    store.publish(R.resolve_source(store, "FT50"))
    assert before == {t: store.read(t).count() for t in before}
    # The journal of 2025 has the first ISSN in ABDC; ABS finds it by the same one.
    named = {r.journal_name: r.match_method for r in store.read("abs_records").join(store.read("entity_match_decisions").where("source_record_table = 'abs_records'").select(F.col("source_record_id").alias("id"), "match_method"), "id").collect()}
    assert named["Journal of 2025 Things"] == "exact_issn"
    views.register(store)
    summary = {r.canonical_title: r for r in spark.table("journal_summary_view").collect()}
    assert summary["Science"].in_ft50 and float(summary["Science"].scimago_current_sjr) == 13.11 and spark.table("journal_source_availability_view").where("has_abs").count() == 2
    store_version = store.version()
    ingest.reset_dataset(store, 5, "ft50_records")
    assert store.version() == store_version + 1 and store.read("ft50_records").count() == 0 and store.read("datasets").where("id = 5").first().status == "pending"
    assert ingest.load_file(store, *files[4]) == "loaded"


def test_many_files_in_one_go(spark, tmp_path, monkeypatch):
    """Of many files of several layouts the broken ones fail by themselves; jobs don't grow with the files."""
    raw = tmp_path / "raw"
    raw.mkdir()

    def write(n):
        for k in range(n):
            rows = "".join(f'{i},"Title, {k} ""of"" {i}",2026\n' for i in range(1, 4 + k % 3))
            text = "rank,journal_name,ft50_year\n" + rows + ('9,"broken\nline",2026\n' if k % 4 == 1 else "")
            (raw / f"f {k:03}+%20.csv").write_bytes(text.encode("latin-1") + ("7,\xc9tude,2026\n".encode("latin-1") if k % 5 == 2 else b""))

    def jobs(f):
        tracker, group = spark.sparkContext.statusTracker(), f"g{write.__hash__()}{len(list(raw.iterdir()))}"
        spark.sparkContext.setJobGroup(group, "")
        out = f()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return out, len(tracker.getJobIdsForGroup(group))

    write(12)
    (raw / "other.csv").write_text("a,b\n1,2\n")
    (raw / "empty.csv").write_text("")
    deep = raw / ("x" * 240) / ("y" * 240)
    deep.mkdir(parents=True)
    (deep / "long.csv").write_text("rank,journal_name,ft50_year\n1,Long,2026\n")
    paths = delimited.discover(spark, str(raw))
    store = state.Store(spark, str(tmp_path / "many"))
    said, few_jobs = jobs(lambda: ingest.import_files(store, "FT50", paths))
    by_name = {p.rsplit("/", 1)[-1]: x for p, x in said.items()}
    failed = {n for n, x in by_name.items() if x.startswith("failed: ")}
    assert failed == {"other.csv", "empty.csv", "long.csv"} and sum(x == "loaded" for x in by_name.values()) == 12 and store.version() == 1
    one_by_one = state.Store(spark, str(tmp_path / "single"))
    for p in [p for p in paths if by_name[p.rsplit("/", 1)[-1]] == "loaded"][:2]:
        ingest.load_file(one_by_one, "FT50", p)
    for name, keys in (("raw_rows", ["id"]), ("ft50_records", ["id"]), ("raw_files", ["id"])):
        few = [r.asDict() for r in one_by_one.read(name).orderBy(*keys).drop("created_at", "dataset_id").collect()]
        many = [r.asDict() for r in store.read(name).orderBy(*keys).limit(len(few)).drop("created_at", "dataset_id").collect()]
        assert few == many and few
    assert {r.status for r in store.read("datasets").collect()} == {"loaded", "failed"} and store.read("datasets").where("status = 'loaded' and record_count is null").count() == 0
    assert store.read("ft50_records").where("journal_name = 'broken line' or journal_name = 'Étude'").count() == 5
    assert set(ingest.import_files(store, "FT50", [p for p in paths if by_name[p.rsplit("/", 1)[-1]] == "loaded"]).values()) == {"skipped"}
    write(40)
    again = state.Store(spark, str(tmp_path / "again"))
    _, many_jobs = jobs(lambda: ingest.import_files(again, "FT50", delimited.discover(spark, str(raw), "f *.csv")))
    assert again.read("raw_files").count() == 40 and many_jobs <= few_jobs * 1.2


@pytest.mark.parametrize("text", ["a,b\n1,2\n", "a,b\n1,2", "a,b\r\n1,2\r\n\r\n3,4\r\n", 'a,b\n"x\ny",2\n3,4\n', "a,b\n1,2\n   \n3,4\n", 'a,b\n5" x 3",2\n3,4\n', "a,b\r1,2\r3,4", "\n\na,b\n1,2\n", "\ufeffa,b\n1,2\n"])
def test_split_and_whole_reads_agree(spark, tmp_path, text, monkeypatch):
    """What the probe lets be read in splits has the same rows that a reading of the whole file has; digests don't depend on the way."""
    import hashlib

    (tmp_path / "x y+%.csv").write_bytes(text.encode())
    path = str(tmp_path / "x y+%.csv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5")
    monkeypatch.setattr(delimited, "WHOLE_BYTES", -1)
    try:
        ((layout, files),) = delimited.layouts(spark, [path]).items()
        rows = lambda whole: sorted((r._row_number, *r[1:]) for r in delimited.read_layout(spark, delimited.Layout(layout.header, ",", "utf-8", layout.split and not whole), [path]).drop("_file").select("_row_number", "*").collect())
        assert rows(False) == rows(True)
        assert layout.split == (not any(x in text for x in ("x\ny", "   ", '"', "\r1", "\n\na")) or '5"' in text)
        (fact,) = delimited.digests(spark, [path]).collect()
        assert (fact.sha256, fact.size, fact.file_path) == (hashlib.sha256(text.encode()).hexdigest(), len(text.encode()), files[0][0])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_tables_of_a_database(spark, tmp_path, capsys):
    """Tables read in ranges of their id, conformed and published; an empty table, one without rows between, and names that aren't known."""
    from folioforge.__main__ import main
    from folioforge.sources import tables

    url, driver = f"jdbc:derby:{tmp_path / 'db'};create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    journals = spark.range(1, 40).select(F.col("id"), F.concat(F.lit("Title "), "id").alias("canonical_title"), F.concat(F.lit("title "), "id").alias("normalized_title"), F.lit(2000).alias("first_observed_year"))
    journals.write.format("jdbc").options(url=url, driver=driver, dbtable="journals").save()
    journals.limit(0).select("id", F.lit("x").alias("rating")).write.format("jdbc").options(url=url, driver=driver, dbtable="abdc_records").save()
    found = tables.read_table(spark, url, "journals", partitions=4, driver=driver)
    assert found.rdd.getNumPartitions() == 4 and found.columns == state.schemas.TABLES["journals"].schema.names
    main([str(tmp_path / "store"), "pull", url, "journals", "abdc_records", "--option", f"driver={driver}"])
    assert "journals: 39" in capsys.readouterr().out
    store = state.Store(spark, str(tmp_path / "store"))
    assert store.version() == 1 and store.read("journals").where("canonical_title = 'Title 7'").first().id == 7 and R.unresolved(store.read("abdc_records")).count() == 0
    with pytest.raises(ValueError):
        tables.read_table(spark, url, "nonsense", driver=driver)


def test_updates_of_journals_are_stamped(spark):
    from folioforge.operators import canonical

    old = state.schemas.conform(spark.createDataFrame([(1, "A", "a"), (2, "B", "b"), (3, "C", "c")], "id long, canonical_title string, normalized_title string").withColumn("updated_at", F.lit("2020-01-01").cast("timestamp")), "journals")
    changes = spark.createDataFrame([(1, "New"), (2, "B"), (9, "none")], "id long, canonical_title string")
    rows = {r.id: (r.canonical_title, r.updated_at.year) for r in canonical.update_journals(old, changes, F.lit("2026-01-01").cast("timestamp")).collect()}
    assert rows == {1: ("New", 2026), 2: ("B", 2026), 3: ("C", 2020)}
    for bad in ("updated_at", "nonsense"):
        with pytest.raises(ValueError):
            canonical.update_journals(old, changes.withColumnRenamed("canonical_title", bad))
    with pytest.raises(Exception, match="changed twice"):
        canonical.update_journals(old, changes.unionByName(changes)).collect()


def test_failed_import_is_marked(spark, tmp_path):
    store = state.Store(spark, str(tmp_path / "store"))
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        ingest.load_file(store, "FT50", str(tmp_path / "bad.csv"))
    assert store.read("datasets").first().status == "failed" and store.read("ft50_records").count() == 0
    with pytest.raises(ValueError):
        ingest.load_file(store, "NOPE", str(tmp_path / "bad.csv"))


def test_unsound_tables_are_not_published(spark, tmp_path):
    store = state.Store(spark, str(tmp_path / "store"))
    rows = spark.createDataFrame([(1, "ISSN", "x", "x"), (2, "ISSN", "x", "x")], "journal_id long, identifier_type string, identifier_value string, normalized_value string")
    with pytest.raises(ValueError):
        store.publish({"journal_identifiers": rows})
    assert store.version() == 0


def test_stream(spark, raw, tmp_path):
    store = state.Store(spark, str(tmp_path / "store"))
    for _ in range(2):
        streaming.watch(store, "FT50", str(raw), str(tmp_path / "cp"), "ft50*.csv").awaitTermination()
    assert store.read("ft50_records").count() == 2
    (raw / "ft50_bad.csv").write_text("a,b\n1,2\n")
    (raw / "ft50_later.csv").write_text("rank,journal_name,ft50_year\n3,Later,2026\n")
    streaming.watch(store, "FT50", str(raw), str(tmp_path / "cp"), "ft50*.csv").awaitTermination()
    assert store.read("ft50_records").count() == 3 and store.read("datasets").where("status = 'failed'").count() == 1


def test_review_loop(spark, tmp_path):
    from folioforge import schemas

    store = state.Store(spark, str(tmp_path / "store"))
    make = lambda name, rows, cols: schemas.conform(spark.createDataFrame(rows, cols), name)
    store.publish(
        {
            "journals": make("journals", [(1, "One", "one"), (2, "Two", "two")], "id long, canonical_title string, normalized_title string"),
            "abdc_records": make("abdc_records", [(k, f"The Record {k}") for k in (10, 11, 12)], "id long, journal_name string"),
            "entity_match_candidates": make("entity_match_candidates", [(k, 2, "abdc_records", r, j, 0.91, "fuzzy_title", 1, s) for k, r, j, s in ((1, 10, 1, "pending"), (2, 10, 2, "pending"), (3, 11, 1, "pending"), (4, 12, 1, "pending"), (5, 12, 2, "rejected"))], "id long, source_id int, source_record_table string, source_record_id long, candidate_journal_id long, similarity double, match_method string, rank_among_candidates int, review_status string"),
        }
    )
    assert review.export_pending(store, str(tmp_path / "queue")) == 4
    rows = spark.read.csv(str(tmp_path / "queue"), header=True)
    assert tuple(rows.columns) == review.EXPORT_COLUMNS
    pick = {"1": "accepted", "3": " NEW_journal", "4": "rejected_no_match"}
    decided = rows.withColumn("decision", F.coalesce(*[F.when(F.col("candidate_id") == k, v) for k, v in pick.items()], F.lit("")))
    changed, stale = review.apply_decisions(store, decided, "me")
    assert stale.count() == 0
    store.publish(changed)
    status = {r.id: r.review_status for r in store.read("entity_match_candidates").collect()}
    assert status == {1: "accepted", 2: "rejected", 3: "rejected", 4: "rejected", 5: "rejected"}
    decisions = {r.source_record_id: (r.decision, r.journal_id) for r in store.read("entity_match_decisions").collect()}
    assert decisions == {10: ("manually_confirmed", 1), 11: ("new_journal", 3), 12: ("rejected_no_match", None)}
    assert store.read("journals").where("id = 3").first().normalized_title == "record 11" and store.read("abdc_records").where("journal_id is not null").count() == 2
    changed, stale = review.apply_decisions(store, decided, "me")
    assert {r.candidate_id: r.current_db_status for r in stale.collect()} == {1: "accepted", 3: "rejected", 4: "rejected"}
    twice = decided.withColumn("decision", F.lit("accepted"))
    with pytest.raises(ValueError):
        review.apply_decisions(store, twice, "me")
    with pytest.raises(ValueError):
        review.apply_decisions(store, decided.withColumn("candidate_id", F.lit("x")), "me")
    with pytest.raises(ValueError):
        review.apply_decisions(store, decided, "")
