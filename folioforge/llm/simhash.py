"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits; the vector of their bit counts is its embedding, and the
Manhattan distance of two embeddings is a lower bound of the fingerprints' Hamming distance. The segments are dealt to
three groups. Of three distances that add up to 4 at most, the two least add up to 2 at most: fingerprints that are to be
linked lie within Manhattan distance 2 of each other on two of the three groups. Points within 2 of each other have a
grid point within 1 of both: each fingerprint is entered, for every two groups, in the unit cells within 1 of it, cells
are equi-joined, and the join's condition counts the differing bits exactly. Copies share a fingerprint and are one point.

Cells are first counted, which is met by partial aggregation. A cell of one point is left out. A cell that very many different fingerprints share (a large group of near copies) would be joined with the
square of its size. Its fingerprints take another exact way: two fingerprints differ in at most 4 bits just if some
64-bit value differs from both in at most 2, so each is linked with the smallest fingerprint of every such value, in
linear time.

Joins on a key that very many rows may share (the centre of a star, a common fingerprint) are dealt by exchanges of
their own on both sides, which the adaptive execution can split where one key's rows are too many for a task.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, fresh, map_arrow, with_row_id

SHINGLE, SEED, DISTANCE = 4, 42, 4
#: Two-bit segments of the three groups, from the lowest bits up.
GROUPS = (11, 11, 10)
#: Cells that a fingerprint is entered in, for ordinary ones, and how many of them a task is to make.
ENTRIES_A_POINT, ENTRIES_A_PARTITION = 97, 4_000_000
_SHIFTS = np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None) -> int:
    """Unsigned. Words are runs of bytes but ASCII white space, A-Z lower-cased; no words: zero; a null text counts as empty."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)), strict=False)) if len(words) >= SHINGLE else [b" ".join(words)]
    digest, counts, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0
    while len(part := np.fromiter((digest(s, SEED) for s in itertools.islice(shingles, 1 << 15)), np.dtype("<u8"))):
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(part)
        if not isinstance(shingles, map):
            break
    return sum(1 << k for k, c in enumerate(counts.tolist()) if 2 * c > n)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp and the carried long columns of every row; fp is the fingerprint as a signed long."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([fingerprint(t) for t in batch.column(0).to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(1), pa.array(made), *batch.columns[2:]], ["doc_id", "fp", *carried])

    narrow = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), *[F.col(f"`{c}`") for c in carried])
    return map_arrow(narrow, run, ", ".join(["doc_id long", "fp long", *(f"`{c}` long" for c in carried)]))


def embedding(fp: Column) -> Column:
    """Bit counts of the 32 two-bit segments of a 64-bit value, each in the two bits of its segment."""
    low = F.lit(0x5555555555555555)
    odd, even = fp.bitwiseAND(low), F.shiftrightunsigned(fp, 1).bitwiseAND(low)
    return odd.bitwiseXOR(even).bitwiseOR(F.shiftleft(odd.bitwiseAND(even), 1))


def _cells(points: DataFrame) -> DataFrame:
    """(cell, fp): for every two groups, the unit cells within Manhattan distance 1 of the embedding on their segments."""
    one, two, three = GROUPS
    v = embedding(F.col("fp"))
    mask = lambda n: F.lit((1 << 2 * n) - 1)
    both = (
        (v.bitwiseAND(mask(one + two)), one + two),
        (F.shiftrightunsigned(v, 2 * one), two + three),
        (F.shiftleft(F.shiftrightunsigned(v, 2 * (one + two)), 2 * one).bitwiseOR(v.bitwiseAND(mask(one))), three + one),
    )
    names = [f"v{k}" for k in range(len(both))]
    # The number of the two groups stands above the bits of any cell.
    placed = points.select("fp", *[(w + F.lit(k << 2 * (one + two))).alias(x) for x, (k, (w, _)) in zip(names, enumerate(both), strict=True)])
    made = []
    for x, (_, n) in zip(names, both, strict=True):
        count = f"(shiftrightunsigned({x}, 2 * i) & 3)"
        made += [
            F.array(x),
            F.expr(f"transform(filter(sequence(0, {n - 1}), i -> {count} < 2), i -> {x} + shiftleft(1L, 2 * i))"),
            F.expr(f"transform(filter(sequence(0, {n - 1}), i -> {count} > 0), i -> {x} - shiftleft(1L, 2 * i))"),
        ]
    return placed.select(F.explode(F.concat(*made)).alias("cell"), "fp")


def _near(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= DISTANCE


def _join_split(many: DataFrame, one: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """many joined with one, which has a row a key. Both are dealt anew, by a value that no earlier exchange was by.

    With an exchange on either side of its own, the adaptive execution splits a key that too many rows of many share.
    """
    left, right = many.withColumn("_dealt", F.bitwise_not(key)), one.withColumn("_dealt", F.bitwise_not(key)).drop(key)
    return left.join(right, "_dealt", how).drop("_dealt")


def links(points: DataFrame, hot_cell: int = 200) -> DataFrame:
    """(a, b), a < b as signed longs: edges whose connected components are those of all pairs within DISTANCE.

    points has distinct fingerprints in fp and is read more than once. From cells of up to hot_cell points come all linked
    pairs; points of larger cells are linked to the smallest point of each value within two bits of them, so no
    component is lost.
    """
    spark = points.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), points.count() * ENTRIES_A_POINT // ENTRIES_A_PARTITION + 1)
    cells = _cells(points.repartition(n))
    shared = durable(cells.join(cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1"), "cell"))
    small = shared.where(F.col("n") <= hot_cell).select("cell", "fp")
    a, b = small.select("cell", F.col("fp").alias("a")), small.select("cell", F.col("fp").alias("b"))
    pairs = a.join(b, "cell").where("a < b").where(_near(F.col("a"), F.col("b"))).select("a", "b")
    hot = shared.where(F.col("n") > hot_cell).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), k) for k in range(64)])
    # Values within two bits: each pair of positions once; the same position twice is the value itself.
    balls = hot.select("fp", F.explode(F.expr("sequence(0, 64)")).alias("i"), flips.alias("flips")).select("fp", F.explode(F.expr("transform(sequence(i, 64), j -> if(i = j and i > 0, fp ^ flips[i], fp ^ flips[i] ^ flips[j]))")).alias("value"))
    least = balls.groupBy("value").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("value", "a")
    stars = _join_split(balls, least, "value").where("a < fp").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node that it reaches.

    Alternates two contractions, of larger and of smaller neighbours to the smallest one, until every edge is that of a
    star's centre and one of its other nodes. Smallest neighbours are met by partial aggregation, and sent to a node's
    edges by joins that can be split. Each round is written to the checkpoint folder.
    """

    def larger(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return _join_split(both.where("b > a"), least, "a").select(F.col("m").alias("a"), "b").where("a != b")

    def smaller(e: DataFrame) -> DataFrame:
        least = e.groupBy("b").agg(F.min("a").alias("m"))
        moved = _join_split(e, least, "b").select(F.col("m").alias("x"), F.col("a").alias("y")).where("x != y")
        return moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).unionByName(least.select(F.col("m").alias("a"), "b")).distinct()

    state = durable(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct())
    for _ in range(max_rounds):
        ends = state.select(F.col("a").alias("node"), F.lit(0).alias("below")).unionByName(state.select("b", F.lit(1)).toDF("node", "below"))
        # Stars: no node is both a centre and below one, or below two.
        if ends.groupBy("node").agg(F.sum("below").alias("n"), F.min("below").alias("centre")).where("n > 1 or (n = 1 and centre = 0)").isEmpty():
            return state.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(state.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        state = durable(smaller(larger(state)))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _classes(made: DataFrame, first: Column, hot_cell: int) -> DataFrame:
    """(fp, root, first): every fingerprint of made with its component's least one and the least value of `first` among its own rows."""
    classes = durable(made.groupBy("fp").agg(F.min(first).alias("first")))
    found = components(links(classes.select("fp"), hot_cell))
    return classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_cell: int = 200) -> DataFrame:
    """One row a document: doc_id, fingerprint (16 hex digits), component_id.

    Documents whose fingerprints differ in DISTANCE bits or fewer are linked; component_id is the smallest doc_id
    reachable, itself included; null if no document of the component has an id. Null and empty texts have
    fingerprint zero and are linked like any other. Repeated rows each give a row. Other columns are not read.
    """
    made = durable(fingerprints(docs, id_col, text_col))
    classes = durable(_classes(made, F.col("doc_id"), hot_cell))
    least = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    of = _join_split(classes.select("fp", "root"), least, "root").select("fp", "component_id")
    return _join_split(made, of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_cell: int = 200) -> DataFrame:
    """The rows of docs, all columns as they are, with one of each component left: that of the smallest doc_id.

    Rows without an id come after all others; of several rows with that id, or without any, the first where docs is
    stored stays. Rows are told apart by where they are stored, not by their id: of one id's rows in different components
    each component keeps its own.
    """
    file, at = fresh(docs, "row_file", "row_at")
    numbered = with_row_id(docs, file, at)
    made = durable(fingerprints(numbered, id_col, text_col, (file, at)))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col(f"`{file}`"), F.col(f"`{at}`"))
    kept = _classes(made, first, hot_cell).groupBy("root").agg(F.min("first").alias("first")).select(F.col(f"first.`{file}`").alias(file), F.col(f"first.`{at}`").alias(at))
    return numbered.join(kept, [file, at], "left_semi").select(*[f"`{c}`" for c in docs.columns])
