"""Document fingerprints: context-triggered piecewise hashing.

A rolling hash over the last seven bytes of a text triggers a chunk boundary where it meets the block size; each
chunk gives one symbol of a signature. The block size, 3 * 2**k, follows from the text's length and is halved while
the signature stays short. A fingerprint holds the signatures at the block size and at twice of it, so that texts
whose block sizes differ by a factor of two still have one in common. Likeness is 1 - edit distance / length of the
longer signature, at compatible block sizes.
"""

from __future__ import annotations

import bisect
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, durable, map_arrow

WINDOW, LEAST_BLOCK, LENGTH = 7, 3, 64
_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_MULTIPLIERS = [pow(0x01000193, k, 1 << 32) for k in range(WINDOW)]
#: Signatures need a run of so many symbols in common, if they are that long, before an edit distance counts.
COMMON_RUN = 4


def rolling(data: bytes) -> np.ndarray:
    """A hash of the last WINDOW bytes at each byte; before the start there are zeros."""
    padded = np.zeros(len(data) + WINDOW - 1, np.uint32)
    padded[WINDOW - 1 :] = np.frombuffer(data, np.uint8)
    padded += np.uint32(1)
    out = np.zeros(len(data), np.uint32)
    for k, m in enumerate(_MULTIPLIERS):
        start = WINDOW - 1 - k
        out += padded[start : start + len(data)] * np.uint32(m)
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x2C1B3C6D)
    out ^= out >> np.uint32(13)
    return out


def signature(data: bytes, hashes: np.ndarray, block: int, length: int = LENGTH) -> str:
    """One symbol a chunk; what is left after `length` - 1 chunks is the last chunk."""
    ends = (np.flatnonzero(hashes % np.uint32(block) == block - 1) + 1)[: length - 1].tolist()
    if not data:
        return ""
    if not ends or ends[-1] != len(data):
        ends.append(len(data))
    out, start = [], 0
    for end in ends:
        out.append(_SYMBOLS[zlib.crc32(data[start:end]) >> 7 & 63])
        start = end
    return "".join(out)


def fingerprint(text: str | None) -> str:
    """block:signature:signature at twice the block; a function of the text alone. A null text counts as empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    hashes, block = rolling(data), LEAST_BLOCK
    while block * LENGTH < len(data):
        block *= 2
    first = signature(data, hashes, block)
    while len(first) < LENGTH // 2 and block > LEAST_BLOCK:
        block //= 2
        first = signature(data, hashes, block)
    return f"{block}:{first}:{signature(data, hashes, 2 * block)}"


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, a bit vector per column."""
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    n = len(a)
    peq: dict[str, int] = {}
    for k, c in enumerate(a):
        peq[c] = peq.get(c, 0) | 1 << k
    full, top, pv, mv, out = (1 << n) - 1, 1 << n - 1, (1 << n) - 1, 0, n
    for c in b:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = ((eq & pv) + pv ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & full, pv & xh
        if ph & top:
            out += 1
        elif mh & top:
            out -= 1
        ph, mh = (ph << 1 | 1) & full, mh << 1 & full
        pv, mv = mh | ~(xv | ph) & full, ph & xv
    return out


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    run = min(COMMON_RUN, len(a), len(b))
    if not run or {a[k : k + run] for k in range(len(a) - run + 1)}.isdisjoint(b[k : k + run] for k in range(len(b) - run + 1)):
        return 0.0
    return 1.0 - edit_distance(a, b) / max(len(a), len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1; equal fingerprints have 1, those at incompatible block sizes 0."""
    if a == b:
        return 1.0
    (x, x1, x2), (y, y1, y2) = a.split(":"), b.split(":")
    x, y = int(x), int(y)
    if x == y:
        return max(_alike(x1, y1), _alike(x2, y2))
    if x == 2 * y:
        return _alike(x1, y2)
    if y == 2 * x:
        return _alike(x2, y1)
    return 0.0


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many, or all, of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row; a null text counts as empty. Other columns are not read."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "fingerprint": pa.array([fingerprint(t) for t in batch.column(1).to_pylist()], pa.string())})

    return map_arrow(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")), run, "doc_id long, fingerprint string")


def _hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


class _Ranges:
    """Ranges of rows in the order of descending id, rows without one last, and of the text's hash within an id.

    Keys are (no id, -id, hash). Range k starts with firsts[k]; `copies` has the keys of more rows than a range is to hold, with
    the number of ranges more that their rows are dealt to.
    """

    def __init__(self, keys: DataFrame, rows_per_range: int, max_ranges: int):
        """keys has doc_id and tie. What comes to the driver is a key a range, and a key for each one of very many rows."""
        counted = durable(keys.groupBy("doc_id", "tie").agg(F.count("*").alias("n")))
        distinct, rows = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        size = max(rows_per_range, -(-rows // max_ranges))
        order = [F.desc_nulls_last("doc_id"), F.asc("tie")]
        dealt = durable(counted.repartitionByRange(max(1, -(-distinct // (64 * size))), *order).withColumn("part", F.spark_partition_id()))
        within = Window.partitionBy("part").orderBy(*order)
        # A key of very many rows counts as one row: the others go elsewhere.
        upto = F.sum(F.least("n", F.lit(size))).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.least("n", F.lit(size))
        cut = dealt.withColumn("cut", F.floor(upto / size))
        starts = F.coalesce(F.lag("cut").over(within) != F.col("cut"), F.lit(True))
        found = cut.withColumn("starts", starts).where(F.col("starts") | (F.col("n") > size)).select("doc_id", "tie", "n", "starts").toArrow()
        keyed = sorted(zip(map(self.key, found["doc_id"].to_pylist(), found["tie"].to_pylist()), found["n"].to_pylist(), found["starts"].to_pylist(), strict=True))
        self.firsts = [k for k, _, starts in keyed if starts]
        self.copies, self.n = {}, len(self.firsts)
        for k, n, _ in keyed:
            if n > size:
                more = -(-n // size)
                self.copies[k] = self.n, more
                self.n += more

    @staticmethod
    def key(doc_id: int | None, tie: int) -> tuple[bool, int, int]:
        return doc_id is None, -(doc_id or 0), tie


def follow_and_compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_range: int = 2000, max_ranges: int = 200_000) -> DataFrame:
    """Every document with its fingerprint, that of its edited text, and two likenesses.

    The following document is the next one in descending doc_id, after the last one the first; rows of the same id
    follow each other in the order of their texts' 64-bit xxHash, rows without an id come last. A null text counts as empty.
    A single row follows itself. Other columns are not read. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    Texts are compressed before the one shuffle, which deals them to ranges of about rows_per_range rows, one a task; a row
    that starts a range is sent to the range before it as well, so that no range waits for another. Of rows alike in id and
    text, if they are too many for a range, all but the first few each follow another of them: they go to ranges of their
    own. There are at most max_ranges ranges of different rows, which bounds what the driver holds.
    """
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), _hash(text).alias("tie"), text.alias("text"))
    ranges = _Ranges(rows.select("doc_id", "tie"), rows_per_range, max_ranges)
    firsts, copies, n = ranges.firsts, ranges.copies, len(ranges.firsts)

    def deal(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        met: dict[tuple, int] = {}
        start = TaskContext.get().partitionId() * 7919
        for batch in batches:
            out = []
            for doc_id, tie, text in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                key = _Ranges.key(doc_id, tie)
                k = bisect.bisect_right(firsts, key) - 1
                starts = firsts[k] == key
                before = met.get(key, 0)
                if starts or key in copies:
                    met[key] = before + 1
                data = pack((text or "").encode("utf-8", "surrogatepass"))
                # The first copy that a task meets stays in its place, so that there is one there; it is also the one that ends the range before.
                if before and key in copies:
                    base, more = copies[key]
                    out.append((base + (start + before) % more, 0, doc_id, tie, data))
                else:
                    out.append((k, 0, doc_id, tie, data))
                if starts and not before:
                    out.append(((k - 1) % n, 1, doc_id, tie, data))
            if out:
                cols = [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(cols, ["part", "extra", "doc_id", "tie", "data"])

    bound_batches(docs.sparkSession)
    dealt = rows.mapInArrow(deal, "part int, extra int, doc_id long, tie long, data binary")
    ordered = dealt.repartitionById(max(1, ranges.n), "part").sortWithinPartitions("part", "extra", F.desc_nulls_last("doc_id"), "tie").drop("tie")

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        held, done = None, None  # the row whose following one comes next: (part, id, text, fingerprint); the part that is over
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

        def row(now, text, mark):
            changed = edited(now[2], text)
            other = fingerprint(changed)
            return now[1], len(now[2]), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), now[3], other, likeness(now[3], other), likeness(now[3], mark)

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

        for batch in batches:
            out = []
            for part, extra, doc_id, data in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                if extra and part == done:
                    continue
                if held and held[0] != part:  # the last of a range of copies follows another copy
                    out.append(row(held, held[2], held[3]))
                    held = None
                text = unpack(data).decode("utf-8", "surrogatepass")
                mark = held[3] if held and held[2] == text else fingerprint(text)
                if held:
                    out.append(row(held, text, mark))
                held, done = (None, part) if extra else ((part, doc_id, text, mark), done)
            if out:
                yield batch_of(out)
        if held:
            yield batch_of([row(held, held[2], held[3])])

    return ordered.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
