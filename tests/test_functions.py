import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioforge.functions import scalars as S
from folioforge.functions import similarity as sim


def column(spark, values, f):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string")
    return [r.x for r in df.select("k", f(F.col("v")).alias("x")).orderBy("k").collect()]


CASES = [
    (S.normalize_issn, {"1614-2411\t": "16142411", "1533-628x": "1533628X", "-": None, None: None, "1234567": None, "12345678X": None}),
    (S.split_multi_issn, {"10959203, 00368075": ["10959203", "00368075"], "bad,0317-8471,0317-8471": ["03178471", "03178471"], None: []}),
    (S.parse_decimal_comma, {"13,110": 13.11, "30,18": 30.18, "101,000": 101.0, "1,2,3": None, "nan": None, "inf": None, " 4.5 ": 4.5, "": None, "abc": None}),
    (S.matching_title, {"The World Economic Journal": "world economic journal", "World Economic Journal": "world economic journal", "A & B: C": "and b c", "The The Band": "the band", None: "", "  x y ": "x y", "C++ = <3": "c++ = <3"}),
    (S.quartile, {"-": None, "Q1": "Q1", " q4": "Q4", "Q5": None}),
    (S.abdc_rating, {"c": "C", "A* ": "A*", None: None, "D": None}),
    (S.parse_int, {"2003.0": 2003, "2003.5": None, "x": None, " 7 ": 7, "1e3": 1000, None: None}),
    (S.parse_year, {"999": None, "1000": 1000, "9999.0": 9999, "10000": None}),
    (S.issn_checksum, {"03785955": True, "03178471": True, "0317847X": False, "nope": False, None: False}),
    (S.yes, {"YES ": True, "no": False, None: False}),
    (S.clean_whitespace, {"  a \t\n b ": "a b", None: "", "　": ""}),
    (S.strip_punctuation, {"a.b-c+d$e«f»": "abc+d$ef"}),
    (S.parse_areas, {"A; ;B ": ["A", "B"], None: []}),
]


@pytest.mark.parametrize("f, cases", CASES, ids=[f.__name__ for f, _ in CASES])
def test_scalars(spark, f, cases):
    assert column(spark, list(cases), f) == list(cases.values())


def test_categories(spark):
    found = column(spark, ["History (Q1); Multi (arts); X (Q5);"], S.parse_categories)[0]
    assert [(c.category_name, c.quartile) for c in found] == [("History", "Q1"), ("Multi (arts)", None), ("X (Q5)", None)]


def test_publisher(spark):
    found = column(spark, ["Econometrica, Econometric Society", "Journal of Economics, Theory and Practice", "Econometrica", ", x", "x ,", "A, B, C Ltd"], S.split_publisher)
    assert [tuple(x) for x in found] == [("Econometrica", "Econometric Society", "high"), ("Journal of Economics, Theory and Practice", None, "low"), ("Econometrica", None, "none"), (", x", None, "low"), ("x ,", None, "low"), ("A, B", "C Ltd", "high")]


def test_row_hash_ignores_column_order(spark):
    a = spark.sql("select 1 as a, cast(null as string) as b").select(S.row_hash(["a", "b"]).alias("h")).first().h
    b = spark.sql("select cast(null as string) as b, 1 as a").select(S.row_hash(["b", "a"]).alias("h")).first().h
    c = spark.sql("select 1 as a, '' as b").select(S.row_hash(["a", "b"]).alias("h")).first().h
    assert a == b != c and len(a) == 64


def test_journal_ids(spark):
    df = spark.createDataFrame([("8;3;8", None), (None, "journal 5 clashes with journal_id=2"), (" ", None)], "l string, m string")
    assert [r.x for r in df.select(S.journal_ids_of("l", "m").alias("x")).collect()] == [[3, 8], [2, 5], []]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for c in a:
        new = [0]
        for k, d in enumerate(b):
            new.append(row[k] + 1 if c == d else max(row[k + 1], new[-1]))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abc é", max_size=25), st.text("abc é", max_size=25))
def test_common_length(a, b):
    assert sim.common_length(a, b) == lcs(a, b)


def test_lcs_in_both_ways(spark):
    rng = random.Random(3)
    rows = [("".join(rng.choices("abcd ", k=rng.randrange(12))), "".join(rng.choices("abcd ", k=rng.randrange(12)))) for _ in range(60)]
    df = spark.createDataFrame(rows, "a string, b string").select("a", "b", sim.lcs_length("a", "b").alias("x"), sim.lcs_length_expression(F.col("a"), F.col("b")).alias("y"))
    assert all(r.x == r.y == lcs(r.a, r.b) for r in df.collect())
