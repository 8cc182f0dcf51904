"""Ranked lexical search: Block-Max WAND over compressed posting blocks, segment by segment.

Documents are indexed where they are read. Every task packs its documents into segments of bounded size; a segment's row holds,
for each term, blocks of up to BLOCK postings: places as differences and occurrences, both packed to the bits they need, and
beside them, to be read without unpacking, the block's first and last place and the largest impact in it. No posting is shuffled.

A batch of items is ranked by one pass over the segments. An item's largest impacts of its terms in a segment are added up
first: below the item's threshold the segment is left. Then the terms' pointers are moved over the blocks' ends alone (a
shallow move): between two neighbouring ends no pointer changes its block, and the sum of the blocks' largest impacts bounds
every document there. Ranges whose bound is below the threshold are passed over, the blocks of the others are unpacked, in
order of places, and their documents get their exact scores. The threshold is the score of the k-th best document that the
task has seen for the item, in this segment or an earlier one; equal scores pass, as the smaller doc_id decides.
Each task gives k documents an item, merged in two steps so that an item's candidates don't meet in one task.

Statistics are of all documents: their number and terms are counted by one aggregation, a term's documents from the segments.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, durable, give_back, map_arrow

TOP, BLOCK = 20, 128
#: A segment ends after so many documents or bytes of text.
SEGMENT_ROWS, SEGMENT_BYTES = 4096, 32 << 20
#: Items of one pass over the index, and distinct terms up to which the index is built for the items' terms alone.
ITEMS_A_PASS, MOST_TERMS = 2000, 500_000
#: Scaled values of the score.
IMPACT, BASE, SHARE, FACTOR = 1_000_000_000, 75, 25, 12
_NO_ID = (1 << 63) - 1
_FOLD = bytes(x + 32 if 65 <= x <= 90 else x if x >= 128 or 48 <= x <= 57 or 97 <= x <= 122 else 32 for x in range(256))
_INDEX = "ids binary, m binary, terms array<binary>, dfs binary, starts binary, firsts binary, lasts binary, tops binary, offsets binary, data binary"


def terms_of(text: str | None) -> list[bytes]:
    """Terms in order, with repeats, A-Z lower-cased; a null text has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return IMPACT * tf // (1000 * tf + FACTOR * m)


def weight(n: int, df: int) -> int:
    """n: documents with a term; df: documents that hold this term."""
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _bits(x: np.ndarray, width: int) -> np.ndarray:
    return (x[:, None] >> np.arange(width) & 1).astype(np.uint8).ravel()


def pack(places: np.ndarray, tf: np.ndarray) -> bytes:
    """A block: its length, the two widths in bits, differences of places, occurrences less one."""
    gaps, more = np.diff(places, prepend=places[:1]), tf - 1
    widths = int(gaps.max()).bit_length(), int(more.max()).bit_length()
    return bytes([len(places) - 1, *widths]) + np.packbits(np.concatenate([_bits(gaps, widths[0]), _bits(more, widths[1])])).tobytes()


def unpack(data: memoryview, first: int) -> tuple[np.ndarray, np.ndarray]:
    n, a, b = data[0] + 1, data[1], data[2]
    bits = np.unpackbits(np.frombuffer(data[3:], np.uint8), count=n * (a + b)).astype(np.int64)
    return first + np.cumsum(bits[: n * a].reshape(n, a) @ (1 << np.arange(a))), 1 + bits[n * a :].reshape(n, b) @ (1 << np.arange(b))


def _segment(ids: list[int | None], counted: list[Counter], lengths: list[int], n: int, total: int) -> dict:
    """The row of a segment; n and total: documents with a term, and their terms, in all of the table."""
    m = BASE + SHARE * np.array(lengths, np.int64) * n // max(total, 1)
    posted: dict[bytes, list[int]] = {}
    for place, c in enumerate(counted):
        for term, tf in c.items():
            posted.setdefault(term, []).extend((place, tf))
    starts, firsts, lasts, tops, offsets, data, dfs = [0], [], [], [], [0], [], []
    for flat in posted.values():
        places, tf = np.array(flat, np.int64).reshape(-1, 2).T
        got = impacts(tf, m[places])
        for i in range(0, len(places), BLOCK):
            p = places[i : i + BLOCK]
            data.append(pack(p, tf[i : i + BLOCK]))
            firsts.append(p[0])
            lasts.append(p[-1])
            tops.append(got[i : i + BLOCK].max())
            offsets.append(offsets[-1] + len(data[-1]))
        starts.append(len(firsts))
        dfs.append(len(places))
    packed = lambda x: np.array(x, "<i8").tobytes()
    return {
        "ids": packed([_NO_ID if x is None else x for x in ids]), "m": m.tobytes(), "terms": list(posted), "dfs": packed(dfs), "starts": packed(starts), "firsts": packed(firsts),
        "lasts": packed(lasts), "tops": packed(tops), "offsets": packed(offsets), "data": b"".join(data),
    }


class Segment:
    """A segment's row, opened: its blocks' bounds at hand, the blocks themselves packed until they are asked for."""

    def __init__(self, row: dict):
        for name in ("ids", "m", "starts", "firsts", "lasts", "tops", "offsets"):
            setattr(self, name, np.frombuffer(row[name], "<i8"))
        self.data, self.of = memoryview(row["data"]), {t: i for i, t in enumerate(row["terms"])}
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and impacts of a block, unpacked once."""
        if b not in self.open:
            places, tf = unpack(self.data[self.offsets[b] : self.offsets[b + 1]], int(self.firsts[b]))
            self.open[b] = places, impacts(tf, self.m[places])
        return self.open[b]


class Best:
    """The k best documents seen for an item: highest scores, then smallest ids."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def threshold(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def rank_segment(seg: Segment, weighted: dict[bytes, int], best: Best) -> None:
    """Bring best up to date with a segment. weighted: an item's terms with their weight times their occurrences in it."""
    lists = [(seg.starts[i], seg.starts[i + 1], w) for t, w in weighted.items() if w and (i := seg.of.get(t)) is not None]
    if not lists or sum(int(seg.tops[a:b].max()) * w for a, b, w in lists) < best.threshold:
        return
    ends = np.unique(np.concatenate([seg.lasts[a:b] for a, b, _ in lists]))
    begins = np.concatenate([[0], ends[:-1] + 1])
    bound, at = np.zeros(len(ends), np.int64), []
    for a, b, w in lists:  # the shallow moves: each list's block at every range
        block = a + np.searchsorted(seg.lasts[a:b], begins)
        inside = np.minimum(block, b - 1)
        touched = (block < b) & (seg.firsts[inside] <= ends)
        bound += np.where(touched, seg.tops[inside] * w, 0)
        at.append(np.where(touched, block, -1))
    todo, step = np.flatnonzero(bound >= best.threshold), 4
    scores = np.zeros(len(seg.ids), np.int64)
    while len(todo):
        now, todo = todo[:step], todo[step:]
        step *= 2
        wanted = np.zeros(len(scores), bool)
        for r in now:
            wanted[begins[r] : ends[r] + 1] = True
        for (_, _, w), blocks in zip(lists, at, strict=True):
            for b in np.unique(blocks[now]):
                if b >= 0:
                    places, got = seg.block(int(b))
                    inside = wanted[places]
                    scores[places[inside]] += got[inside] * w
        found = np.flatnonzero(wanted & (scores >= best.threshold))
        if len(found):
            best.add(scores[found], seg.ids[found])
            todo = todo[bound[todo] >= best.threshold]


def statistics(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """(documents with a term, terms of all documents with repeats)."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths = [len(terms_of(t.as_py())) for t in batch.column("text")]
        return pa.RecordBatch.from_arrays([pa.array([sum(map(bool, lengths))], pa.int64()), pa.array([sum(lengths)], pa.int64())], ["n", "total"])

    each = map_arrow(docs.select(F.col(f"`{text_col}`").cast("string").alias("text")), count, "n long, total long")
    row = each.agg(F.sum("n"), F.sum("total")).first()
    return row[0] or 0, row[1] or 0


def build_index(docs: DataFrame, stats: tuple[int, int], only: frozenset[bytes] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The segments of all documents, a row each, written to the checkpoint folder; of the terms in `only`, if it's given."""
    sent = docs.sparkSession.sparkContext.broadcast(only) if only is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if sent is None else sent.value
        ids, counted, lengths, size = [], [], [], 0

        def made() -> pa.RecordBatch:
            row = _segment(ids, counted, lengths, *stats)
            kinds = [pa.list_(pa.binary()) if k == "terms" else pa.binary() for k in row]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)], list(row))

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                terms = terms_of(text.as_py())
                ids.append(doc_id)
                lengths.append(len(terms))
                counted.append(Counter(terms if wanted is None else filter(wanted.__contains__, terms)))
                size += len(text.as_py() or "")
                if len(ids) >= SEGMENT_ROWS or size >= SEGMENT_BYTES:
                    yield made()
                    ids, counted, lengths, size = [], [], [], 0
        if ids:
            yield made()
        give_back()

    bound_batches(docs.sparkSession)
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return durable(narrow.mapInArrow(run, _INDEX))


def document_frequencies(index: DataFrame, terms: frozenset[bytes]) -> dict[bytes, int]:
    """In how many documents each of the terms stands; the terms go to every task."""
    sent = index.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for own, dfs in zip(batch.column("terms").to_pylist(), batch.column("dfs").to_pylist(), strict=True):
                total.update({t: n for t, n in zip(own, np.frombuffer(dfs, "<i8").tolist(), strict=True) if t in sent.value})
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(total.values(), pa.int64())], ["term", "df"])
        give_back()

    return {bytes(t): n for t, n in index.select("terms", "dfs").mapInArrow(run, "term binary, df long").groupBy("term").agg(F.sum("df")).collect()}


def _candidates(index: DataFrame, items: list[tuple[int, dict[bytes, int]]], k: int) -> DataFrame:
    """(item, doc_id, score): each task's k best documents of each item."""
    sent = index.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {item: Best(k) for item, _ in sent.value}
        for batch in batches:
            for row in batch.to_pylist():
                seg = Segment(row)
                for item, weighted in sent.value:
                    rank_segment(seg, weighted, best[item])
        for item, b in best.items():
            if len(b.ids):
                ids = pa.array(b.ids, mask=b.ids == _NO_ID)
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(b.ids), pa.int64()), ids, pa.array(b.scores)], ["item", "doc_id", "score"])
        give_back()

    return index.mapInArrow(run, "item long, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Each item's k documents with the highest scores above 0: item_id, rank (from 1), doc_id, score.

    Scores are as impacts() and weight() have them, over the item's terms with repeats; equal scores are ranked by doc_id,
    rows without an id after all others. Null and empty texts have no term: as documents they are in no result, as items
    they have none. Each row of items is an item of its own, repeated or not, and each row of docs a document. Empty tables
    give no rows. Other columns are not read. Items are taken ITEMS_A_PASS at a time, whatever their number.
    """
    if k < 1:
        raise ValueError("k must be positive")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        counted = [Counter(terms_of(t)) for t in batch.column("text").to_pylist()]
        arrays = [batch.column("item"), batch.column("item_id"), pa.array([list(c) for c in counted], pa.list_(pa.binary())), pa.array([list(c.values()) for c in counted], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, ["item", "item_id", "terms", "times"])

    numbered = items.select(F.monotonically_increasing_id().alias("item"), F.col(f"`{item_id_col}`").cast("long").alias("item_id"), F.col(f"`{item_text_col}`").cast("string").alias("text"))
    asked = durable(map_arrow(numbered, count, "item long, item_id long, terms array<binary>, times array<long>"))
    terms = asked.select(F.explode("terms").alias("term")).distinct().limit(MOST_TERMS + 1).collect()
    stats = statistics(docs, text_col)
    index = build_index(docs, stats, frozenset(bytes(r.term) for r in terms) if len(terms) <= MOST_TERMS else None, id_col, text_col)
    passes, chunk, found = [], [], None
    for row in asked.toLocalIterator():
        chunk.append((row.item, {bytes(t): n for t, n in zip(row.terms, row.times, strict=True)}))
        if len(chunk) == ITEMS_A_PASS:
            passes.append(durable(_candidates(index, _weighted(index, chunk, stats[0]), k)))
            chunk = []
    if chunk or not passes:
        passes.append(_candidates(index, _weighted(index, chunk, stats[0]), k))
    for each in passes:
        found = each if found is None else found.unionByName(each)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.spark_partition_id(), F.lit(64))
    some = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= k)
    top = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    return top.join(asked.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _weighted(index: DataFrame, items: list[tuple[int, dict[bytes, int]]], n: int) -> list[tuple[int, dict[bytes, int]]]:
    df = document_frequencies(index, frozenset(t for _, c in items for t in c))
    return [(item, {t: times * weight(n, df[t]) for t, times in c.items() if t in df}) for item, c in items]
