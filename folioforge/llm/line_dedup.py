"""Line dedup: lines that very many documents share, dropped by probing arrays behind sharded minimal perfect hashes.

A line's key is hashed to 128 bits. One aggregation counts the documents of each distinct hash; what is found in fewer
documents than asked for can never be dropped and goes no further. The others are dealt to shards by their highest bits,
so that a shard has a bounded number of keys however often its lines occur. Each shard gets a minimal perfect hash, levels of
bit arrays in which a key takes the first place it has alone; a key's rank among the places taken is its slot in two compact
arrays: the hash's other 64 bits as a fingerprint, and the count of documents. No line is stored.

Documents find their lines' slots and compare fingerprints: no line is joined or shuffled a second time. While
the arrays are small, by their size as counted, they go to the tasks by broadcast. Beyond `broadcast_bytes` they stay where
they are and the documents' hashes are routed to the shards instead; a shard whose lines are frequent is then copied as often
as its counts tell. Both ways give the same rows.

A line of no index is taken for one with a chance of 2 ** -64 a probe.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, durable, fresh, give_back, map_arrow, with_row_id

MIN_DOCS, MIN_CHARS = 10, 1
#: Bits of a level for each key that is still without a place.
ROOM = 2
KEYS_A_SHARD, LEAST_SHARD_BITS, MOST_SHARD_BITS = 1 << 15, 6, 20
#: Fingerprint, count and some 4 bits of levels.
BYTES_A_KEY = 13
BROADCAST_BYTES = 32 << 20
#: Probes of one copy of a shard, where hashes are routed.
PROBES_A_COPY = 1 << 18
_PAIR = np.dtype([("a", "<u8"), ("b", "<u8")])
_INDEX = "shard int, sizes array<long>, levels binary, marks binary, counts binary"


def keys_of(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """A text's lines and their keys: white space of ASCII stripped, A-Z lower-cased. A null text is one empty line."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return data.split(b"\n"), [x.strip() for x in data.lower().split(b"\n")]


def _counts_as_line(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars < 2 or len(key.decode("utf-8", "surrogatepass")) >= min_chars)


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), _PAIR)


def _place(pairs: np.ndarray, level: int, size: int) -> np.ndarray:
    """Places of hashes on a level; both halves count, each level mixes them anew."""
    with np.errstate(over="ignore"):
        x = pairs["a"] * np.uint64(2 * level + 1) + pairs["b"] * np.uint64(4 * level + 3)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return (x ^ (x >> np.uint64(29))) % np.uint64(size)


class Shard:
    """A minimal perfect hash over distinct 128-bit hashes, with their fingerprints and counts by slot."""

    def __init__(self, sizes: list[int], levels: bytes, marks: bytes, counts: bytes):
        self.sizes, self.levels, self.marks, self.counts = sizes, np.frombuffer(levels, "<u8"), np.frombuffer(marks, "<u8"), np.frombuffer(counts, "<u4")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.levels).astype(np.int64))])

    @classmethod
    def build(cls, pairs: np.ndarray, counts: np.ndarray) -> Shard:
        sizes, levels, rest = [], [], pairs
        while len(rest):
            size = -(-ROOM * len(rest) // 64) * 64
            place = _place(rest, len(sizes), size).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone, bitorder="little").tobytes())
            rest = rest[~alone[place]]
        made = cls(sizes, b"".join(levels), b"", b"")
        slots, marks, kept = made.slots(pairs), np.zeros(len(pairs), "<u8"), np.zeros(len(pairs), "<u4")
        marks[slots], kept[slots] = pairs["b"], np.minimum(counts, (1 << 32) - 1)
        return cls(sizes, b"".join(levels), marks.tobytes(), kept.tobytes())

    def slots(self, pairs: np.ndarray) -> np.ndarray:
        """The slot of each hash: its own for those of the index, any or -1 for others."""
        out, todo, first = np.full(len(pairs), -1, np.int64), np.arange(len(pairs)), 0
        for level, size in enumerate(self.sizes):
            if not len(todo):
                break
            place = _place(pairs[todo], level, size).astype(np.int64) + first
            word, bit = self.levels[place >> 6], (place & 63).astype(np.uint64)
            taken = (word >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[todo[taken]] = (self.before[place >> 6] + below)[taken]
            todo, first = todo[~taken], first + size
        return out

    def probe(self, pairs: np.ndarray) -> np.ndarray:
        """Counts of the hashes; 0 for those that aren't in the index."""
        slot = self.slots(pairs)
        found = slot >= 0
        found[found] = self.marks[slot[found]] == pairs["b"][found]
        out = np.zeros(len(pairs), np.int64)
        out[found] = self.counts[slot[found]]
        return out


def line_counts(docs: DataFrame, text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(a, b, n): the two halves of each distinct key's hash, as signed longs, and the documents (rows) it is found in."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        digests = [xxhash.xxh3_128_digest(k) for text in batch.column(0).to_pylist() for k in {*keys_of(text)[1]} if _counts_as_line(k, min_chars)]
        if not digests:
            return None
        pairs, n = np.unique(np.frombuffer(b"".join(digests), _PAIR), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pairs[c].view("<i8")) for c in "ab"] + [pa.array(n)], ["a", "b", "n"])

    each = map_arrow(docs.select(F.col(f"`{text_col}`").cast("string").alias("text")), run, "a long, b long, n long")
    return each.groupBy("a", "b").agg(F.sum("n").alias("n"))


def build_index(counts: DataFrame) -> tuple[DataFrame, int, int]:
    """(shards, keys, bits): a row a shard of the hashes in counts, written; how many hashes there are; bits of a shard's number."""
    counts = durable(counts)
    keys = counts.count()
    bits = min(MOST_SHARD_BITS, max(LEAST_SHARD_BITS, (keys // KEYS_A_SHARD).bit_length()))

    def build(group: pa.Table) -> pa.Table:
        pairs = np.empty(group.num_rows, _PAIR)
        for c in "ab":
            pairs[c] = group.column(c).to_numpy().view("<u8")
        made = Shard.build(pairs, group.column("n").to_numpy())
        row = {"shard": pa.array([group.column("shard")[0].as_py()], pa.int32()), "sizes": pa.array([made.sizes], pa.list_(pa.int64())), "levels": [made.levels.tobytes()], "marks": [made.marks.tobytes()], "counts": [made.counts.tobytes()]}
        return pa.table({k: v if isinstance(v, pa.Array) else pa.array(v, pa.binary()) for k, v in row.items()})

    dealt = counts.withColumn("shard", F.shiftrightunsigned("a", 64 - bits).cast("int"))
    return durable(dealt.groupBy("shard").applyInArrow(build, _INDEX)), keys, bits


def _in_shards(pairs: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that some of the hashes belong to, with where these stand."""
    shard = (pairs["a"] >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
        if len(part):
            yield int(shard[part[0]]), part


_OUT = "doc_id long, kept_text string, n_lines long, n_dropped long, most_docs long"


def _outcome(lines: list[bytes], dropped: dict[int, int]) -> tuple[str, int, int, int | None]:
    kept = b"\n".join(x for i, x in enumerate(lines) if i not in dropped) if dropped else b"\n".join(lines)
    return kept.decode("utf-8", "surrogatepass"), len(lines), len(dropped), max(dropped.values(), default=None)


def _outcomes(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([ids, *(pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], ["doc_id", "kept_text", "n_lines", "n_dropped", "most_docs"])


def _by_broadcast(narrow: DataFrame, shards: DataFrame, bits: int, min_chars: int) -> DataFrame:
    sent = narrow.sparkSession.sparkContext.broadcast([tuple(r) for r in shards.collect()])
    opened: dict[int, Shard] = {}

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if sent.value and not opened:
            opened.update((k, Shard(sizes, *map(bytes, arrays))) for k, sizes, *arrays in sent.value)
        texts = [keys_of(t) for t in batch.column("text").to_pylist()]
        places = [(d, i) for d, (_, keys) in enumerate(texts) for i, k in enumerate(keys) if _counts_as_line(k, min_chars)]
        pairs = _hashes([texts[d][1][i] for d, i in places])
        dropped: list[dict[int, int]] = [{} for _ in texts]
        for k, part in _in_shards(pairs, bits):
            if k in opened:
                for j, n in zip(part.tolist(), opened[k].probe(pairs[part]).tolist(), strict=True):
                    if n:
                        d, i = places[j]
                        dropped[d][i] = n
        return _outcomes(batch.column("doc_id"), [_outcome(lines, dropped[d]) for d, (lines, _) in enumerate(texts)])

    return map_arrow(narrow.select("doc_id", "text"), run, _OUT)


def _by_routing(docs: DataFrame, shards: DataFrame, bits: int, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """Hashes of each document go to the shards' tasks, a row a document and shard; what they find goes back to the document."""
    file, at = fresh(docs, "row_file", "row_at")
    rows = with_row_id(docs, file, at).select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{file}`").alias("file"), F.col(f"`{at}`").alias("at"))

    def ask(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        out = []
        for text, *where in zip(*(batch.column(c).to_pylist() for c in ("text", "file", "at")), strict=True):
            keys = keys_of(text)[1]
            lines = np.array([i for i, k in enumerate(keys) if _counts_as_line(k, min_chars)], "<i4")
            pairs = _hashes([keys[i] for i in lines])
            out += [(k, *where, lines[part].tobytes(), pairs[part].tobytes()) for k, part in _in_shards(pairs, bits)]
        if not out:
            return None
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["shard", "file", "at", "lines", "hashes"])

    def total(batch: pa.RecordBatch) -> pa.RecordBatch:
        copies = [1 + int(np.frombuffer(c, "<u4").sum(dtype=np.int64)) // PROBES_A_COPY for c in batch.column("counts").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("shard"), pa.array(copies, pa.int32())], ["shard", "copies"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, which = None, None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["levels"] is not None:
                    opened, which = Shard(r["sizes"], r["levels"], r["marks"], r["counts"]), r["shard"]
                elif which == r["shard"]:
                    n = opened.probe(np.frombuffer(r["hashes"], _PAIR))
                    if n.any():
                        out.append((r["file"], r["at"], np.frombuffer(r["lines"], "<i4")[n > 0].tolist(), n[n > 0].tolist()))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["file", "at", "lines", "found"])
        give_back()

    copies = F.broadcast(map_arrow(shards.select("shard", "counts"), total, "shard int, copies int"))  # at most 2 ** MOST_SHARD_BITS rows
    asked = map_arrow(rows.select("text", "file", "at"), ask, "shard int, file long, at long, lines binary, hashes binary").join(copies, "shard")
    asked = asked.withColumn("copy", F.pmod(F.xxhash64("file", "at"), "copies").cast("int")).drop("copies")
    arrays = shards.join(copies, "shard").withColumn("copy", F.explode(F.expr("sequence(0, copies - 1)"))).drop("copies")
    met = arrays.unionByName(asked, allowMissingColumns=True).repartition("shard", "copy").sortWithinPartitions("shard", "copy", F.col("levels").isNull())
    bound_batches(docs.sparkSession)
    told = met.mapInArrow(answer, "file long, at long, lines array<int>, found array<long>")
    told = told.groupBy("file", "at").agg(F.flatten(F.collect_list("lines")).alias("lines"), F.flatten(F.collect_list("found")).alias("found"))

    def drop(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, lines, found = (batch.column(c).to_pylist() for c in ("text", "lines", "found"))
        return _outcomes(batch.column("doc_id"), [_outcome(keys_of(t)[0], dict(zip(i or [], n or [], strict=True))) for t, i, n in zip(texts, lines, found, strict=True)])

    return map_arrow(rows.join(told, ["file", "at"], "left").select("doc_id", "text", "lines", "found"), drop, _OUT)


def drop_common_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row a document: doc_id, kept_text, n_lines (before), n_dropped, most_docs.

    Lines are parted by line feeds alone. Every line whose key has min_chars code points or more and is found in min_docs
    documents or more is dropped, wherever it stands; the others are joined as they were. most_docs is the largest
    number of documents that a dropped line is found in (up to 2 ** 32 - 1), null if none was dropped. A null or empty text is
    one empty line, whose key is never dropped unless min_chars is 0. A document is a row: repeated rows each count and each
    give a row, ids may be null. Other columns are not read.
    """
    if min_docs < 1 or min_chars < 0:
        raise ValueError("min_docs must be positive, min_chars not negative")
    shards, keys, bits = build_index(line_counts(docs, text_col, min_chars).where(F.col("n") >= min_docs))
    if keys * BYTES_A_KEY > broadcast_bytes:
        return _by_routing(docs, shards, bits, min_chars, id_col, text_col)
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return _by_broadcast(narrow, shards, bits, min_chars)
