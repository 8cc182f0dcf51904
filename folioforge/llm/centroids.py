"""Centroid clustering by Lloyd's rounds on integer vectors, with Yinyang's bounds to leave distances out.

Centroids are put into groups once, at the start. Each vector keeps an upper bound of the distance to its own centroid and one
lower bound for each group, of the distances to the group's others; after a round the bounds are moved by how far the
centroids went. A vector whose upper bound lies below all its lower bounds stays as it is; else its own distance is
computed, and if that doesn't settle it, only the groups whose lower bound isn't above it are opened, and in them only the
centroids that the group's bound before the round, less the centroid's own way, leaves a chance. These are scanned
exactly, in integers, so that ties go to the smaller number. Bounds are floating-point numbers, rounded outwards.

Vectors stand in blocks, a row a block, that stay in their partition from round to round with their bounds; no
vector is shuffled. A round sends to the driver one sum for each centroid that vectors went to or left: their number and
components don't grow with the data. Every round's blocks are written to the checkpoint folder, so that a lost executor costs its
part of one round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, durable, give_back, map_arrow

SEED, CLUSTERS, ROUNDS, DIMENSIONS, SCALE = 3, 8, 10, 64, 1024
#: Beyond this size of a component (after scaling) a squared distance is no long.
LARGEST = 1 << 27
#: Components up to here have exact products and sums in doubles.
IN_DOUBLES = 1 << 22
#: Centroids of a group, and rounds in which they are grouped.
A_GROUP, GROUPING_ROUNDS = 3, 5
#: Centroids are held by the driver and by every task.
MOST_CENTROIDS = 10_000
_BLOCK = "ids array<long>, vectors binary, cluster binary, upper binary, lower binary, distance binary, exact long, centres array<int>, counts array<long>, sums binary"


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of v and rows of c, both of longs."""
    if max(np.abs(v).max(initial=0), np.abs(c).max(initial=0)) <= IN_DOUBLES:
        dots = (v.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    else:
        dots = v @ c.T
    return (v * v).sum(axis=1)[:, None] - 2 * dots + (c * c).sum(axis=1)


def _own(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((v - c) ** 2).sum(axis=1)


def _up(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64)) * (1 + 1e-12)


def _down(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64)) * (1 - 1e-12)


def group_centroids(centres: np.ndarray) -> np.ndarray:
    """The group of each centroid: a few rounds of the same clustering over the centroids themselves."""
    k = len(centres)
    middles, of = centres[:: max(1, A_GROUP)].copy(), np.zeros(k, np.int64)
    for _ in range(GROUPING_ROUNDS):
        of = squared(centres, middles).argmin(axis=1)
        for g in np.unique(of):
            middles[g] = centres[of == g].sum(axis=0) // (of == g).sum()
    return np.unique(of, return_inverse=True)[1]


@dataclass
class Bounds:
    """What a block knows of its vectors."""

    cluster: np.ndarray
    upper: np.ndarray
    lower: np.ndarray  # a row a vector, a column a group
    exact: int = 0  # distances computed in the last round


def first_bounds(v: np.ndarray, centres: np.ndarray, groups: np.ndarray) -> Bounds:
    d2 = squared(v, centres)
    cluster = d2.argmin(axis=1)
    rows = np.arange(len(v))
    upper = _up(d2[rows, cluster])
    roots = _down(d2)
    roots[rows, cluster] = np.inf
    lower = np.stack([roots[:, groups == g].min(axis=1) for g in range(groups.max() + 1)], axis=1)
    return Bounds(cluster, upper, lower, d2.size)


def next_bounds(v: np.ndarray, was: Bounds, centres: np.ndarray, groups: np.ndarray, moved: np.ndarray) -> Bounds:
    """The bounds after the centroids moved, each by moved (rounded up): filtered globally, by group, then by centroid."""
    furthest = np.array([moved[groups == g].max() for g in range(groups.max() + 1)])
    out = Bounds(was.cluster.copy(), was.upper + moved[was.cluster], was.lower - furthest)
    nearest = out.lower.min(axis=1)
    todo = np.flatnonzero(out.upper >= nearest)
    if not len(todo):
        return out
    own = _own(v[todo], centres[out.cluster[todo]])
    out.exact = len(todo)
    out.upper[todo] = _up(own)
    open_ = out.upper[todo] >= nearest[todo]
    todo, own = todo[open_], own[open_]
    if not len(todo):
        return out
    vectors, before = v[todo], out.cluster[todo].copy()
    best, who, lower, old = own.copy(), before.copy(), out.lower[todo], was.lower[todo]
    for g in range(lower.shape[1]):
        opened = np.flatnonzero(lower[:, g] <= _up(best))
        if not len(opened):
            continue
        # The old centroid's distance is known; while it's the best, it isn't one of its group's others.
        lower[opened, g] = np.where((groups[before[opened]] == g) & (who[opened] != before[opened]), _down(own[opened]), np.inf)
        for c in np.flatnonzero(groups == g):
            rows = opened[before[opened] != c]
            bound = old[rows, g] - moved[c]
            chance = bound <= _up(best[rows])
            passed, rows = rows[~chance], rows[chance]
            lower[passed, g] = np.minimum(lower[passed, g], bound[~chance])
            if not len(rows):
                continue
            d2 = squared(vectors[rows], centres[c : c + 1])[:, 0]
            out.exact += len(rows)
            wins = (d2 < best[rows]) | ((d2 == best[rows]) & (c < who[rows]))
            lost = rows[~wins]
            lower[lost, g] = np.minimum(lower[lost, g], _down(d2[~wins]))
            won = rows[wins]
            lower[won, groups[who[won]]] = np.minimum(lower[won, groups[who[won]]], _down(best[won]))
            best[won], who[won] = d2[wins], c
    out.cluster[todo], out.upper[todo], out.lower[todo] = who, _up(best), lower
    return out


def _changes(v: np.ndarray, old: np.ndarray | None, new: np.ndarray) -> tuple[list[int], list[int], bytes]:
    """Centroids that vectors went to or left, with the change of their number and of their sum."""
    went = np.arange(len(new)) if old is None else np.flatnonzero(old != new)
    touched = np.unique(np.concatenate([new[went], [] if old is None else old[went]]).astype(np.int64))
    sums, counts = np.zeros((len(touched), v.shape[1]), np.int64), np.zeros(len(touched), np.int64)
    for at, sign in ((new, 1), (old, -1)):
        if at is not None:
            place = np.searchsorted(touched, at[went])
            np.add.at(sums, place, sign * v[went])
            np.add.at(counts, place, sign)
    return touched.tolist(), counts.tolist(), sums.tobytes()


def _row(ids: pa.Array, vectors: bytes, at: Bounds, distance: np.ndarray | None, changes: tuple[list[int], list[int], bytes]) -> pa.RecordBatch:
    given = {
        "ids": pa.array([ids], pa.list_(pa.int64())), "vectors": pa.array([vectors], pa.binary()), "cluster": pa.array([at.cluster.astype("<i4").tobytes()], pa.binary()), "upper": pa.array([at.upper.astype("<f8").tobytes()], pa.binary()), "lower": pa.array([at.lower.astype("<f8").tobytes()], pa.binary()),
        "distance": pa.array([None if distance is None else distance.astype("<i8").tobytes()], pa.binary()), "exact": pa.array([at.exact], pa.int64()), "centres": pa.array([changes[0]], pa.list_(pa.int32())), "counts": pa.array([changes[1]], pa.list_(pa.int64())), "sums": pa.array([changes[2]], pa.binary()),
    }
    return pa.RecordBatch.from_arrays(list(given.values()), list(given))


def _totals(blocks: DataFrame, width: int) -> dict[int, tuple[int, list[int]]]:
    """Number and sums of what the blocks say of each centroid: added up in each partition, then over all."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for centres, counts, sums in zip(*(batch.column(c).to_pylist() for c in ("centres", "counts", "sums")), strict=True):
                for c, n, s in zip(centres, counts, np.frombuffer(sums, np.int64).reshape(-1, width), strict=True):
                    total[c] = total.get(c, 0) + np.append(s, n)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tolist() for x in total.values()], pa.list_(pa.int64()))], ["centre", "total"])
        give_back()

    each = blocks.select("centres", "counts", "sums").mapInArrow(add, "centre int, total array<long>")
    rows = each.groupBy("centre").agg(*[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(width + 1)]).collect()
    return {r[0]: (r[-1], list(r[1:-1])) for r in rows}


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows whose vector has that many components, all of them finite numbers: floor(scale * x) each.

    Rows without a vector, or with a component whose scaled size is over LARGEST, are left out.
    """
    x = F.col(f"`{vector_col}`").cast("array<double>")
    fine = (F.size(x) == dimensions) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) <= F.lit(LARGEST / scale)))
    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), x.alias("v")).where(F.coalesce(fine, F.lit(False))).select("vec_id", F.transform("v", lambda e: F.floor(e * scale)).alias("v"))


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row a kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Kept are the rows that integer_vectors() keeps. Centroids start as the k vectors with the smallest hex sha256 of
    `<seed>:<vec_id>`, numbered in this order (equal ids by their components, rows without an id last; fewer vectors than
    k: as many centroids). Each round assigns all vectors, a tie to the smaller number, and replaces each centroid that has
    vectors by the floor of their componentwise mean; a last assignment follows. No vectors: no rows. Repeated rows each count
    and give a row; ids may be null. Other columns are not read.
    """
    if not 1 <= k <= MOST_CENTROIDS or rounds < 0:
        raise ValueError(f"k must be 1 to {MOST_CENTROIDS}, rounds not negative")
    kept = integer_vectors(vectors, dimensions, scale, id_col, vector_col)
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    starts = kept.select("v", drawn.alias("drawn"), "vec_id").orderBy(F.asc_nulls_last("drawn"), F.asc_nulls_last("vec_id"), "v").limit(k).collect()
    centres = np.array([r.v for r in starts], np.int64).reshape(-1, dimensions)
    if not len(centres):
        empty = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return kept.sparkSession.createDataFrame([], empty)
    groups = group_centroids(centres)

    state = durable(map_arrow(kept, _beginning(centres, groups, rounds == 0), _BLOCK))
    sums, counts = np.zeros(centres.shape, object), np.zeros(len(centres), object)
    for done in range(1, rounds + 1):
        for c, (n, total) in _totals(state, dimensions).items():
            counts[c] += n
            sums[c] += np.array(total, object)
        old, centres = centres, centres.copy()
        for c in np.flatnonzero(counts > 0):
            centres[c] = [s // int(counts[c]) for s in sums[c]]
        state = durable(state.mapInArrow(_stepping(centres, groups, _up(_own(old, centres)), done == rounds), _BLOCK))
    return _report(state, centres)


def _beginning(centres: np.ndarray, groups: np.ndarray, last: bool) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        v = batch.column("v").flatten().to_numpy().reshape(-1, centres.shape[1])
        at = first_bounds(v, centres, groups)
        return _row(batch.column("vec_id"), v.astype("<i4").tobytes(), at, _own(v, centres[at.cluster]) if last else None, _changes(v, None, at.cluster))

    return run


def _stepping(centres: np.ndarray, groups: np.ndarray, moved: np.ndarray, last: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_buffer() for c in ("vectors", "cluster", "upper", "lower")}
                v = np.frombuffer(r["vectors"], "<i4").astype(np.int64).reshape(-1, centres.shape[1])
                was = Bounds(np.frombuffer(r["cluster"], "<i4").astype(np.int64), np.frombuffer(r["upper"], "<f8"), np.frombuffer(r["lower"], "<f8").reshape(len(v), -1))
                at = next_bounds(v, was, centres, groups, moved)
                yield _row(batch.column("ids")[i].values, r["vectors"].to_pybytes(), at, _own(v, centres[at.cluster]) if last else None, _changes(v, was.cluster, at.cluster))
        give_back()

    return run


def _report(state: DataFrame, centres: np.ndarray) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(centres), np.int64)
        for batch in batches:
            for cluster, distance in zip(*(batch.column(c).to_pylist() for c in ("cluster", "distance")), strict=True):
                np.add.at(total, np.frombuffer(cluster, "<i4"), np.frombuffer(distance, "<i8"))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["cluster", "inertia"])
        give_back()

    each = state.select("cluster", "distance").mapInArrow(add, "cluster int, inertia long")
    inertia = dict(each.groupBy("cluster").agg(F.sum("inertia")).collect())
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    whole = sum(inertia.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                of = np.frombuffer(batch.column("cluster")[i].as_buffer(), "<i4")
                columns = [batch.column("ids")[i].values, pa.array(of), pa.array(np.frombuffer(batch.column("distance")[i].as_buffer(), "<i8"))]
                columns += [pa.array([inertia[c] for c in of.tolist()], pa.int64()), pa.array([whole] * len(of), pa.int64()), pa.array([digests[c] for c in of.tolist()], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])
        give_back()

    bound_batches(state.sparkSession)
    return state.select("ids", "cluster", "distance").mapInArrow(run, "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
