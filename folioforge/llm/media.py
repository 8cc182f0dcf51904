"""Media columns: PNG images in binary columns.

The reader takes a PNG apart chunk by chunk, tests every chunk's checksum, inflates the image data with zlib and undoes
the row filters with numpy. The writer makes such images from raw samples. A picture's feature is a hash of the lowest
frequencies of the cosine transform of its brightness.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

SIGNATURE = b"\x89PNG\r\n\x1a\n"
WIDTH, CHANNELS = 64, 3
ROW = WIDTH * CHANNELS
SIDE, LOW = 32, 8
#: Rows that the writer looks at together, so that it needs a bounded multiple of them beside the image.
SLAB = 4096
_CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}
_COSINES = np.array([[np.cos(np.pi * (2 * x + 1) * u / (2 * SIDE)) for x in range(SIDE)] for u in range(LOW)])


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def write_png(samples: np.ndarray) -> bytes:
    """8-bit samples (height, width, channels) as a PNG; each row is filtered by none, left or up, whichever has the least sum."""
    height, width, channels = samples.shape
    kind = {n: k for k, n in _CHANNELS.items()}[channels]
    whole = samples.reshape(height, width * channels)
    pack, packed = zlib.compressobj(6), []
    for start in range(0, height, SLAB):
        raw = whole[start : start + SLAB]
        left, up = raw.copy(), raw.copy()
        left[:, channels:] -= raw[:, :-channels]
        up[1:] -= raw[:-1]
        if start:
            up[0] -= whole[start - 1]
        forms = np.stack([raw, left, up])
        costs = np.abs(forms.view(np.int8).astype(np.int16)).sum(axis=2)
        costs[0] //= 3  # text and flat colours repeat themselves, which deflate finds in rows as they are
        best = costs.argmin(axis=0)
        lines = np.empty((len(raw), raw.shape[1] + 1), np.uint8)
        lines[:, 0], lines[:, 1:] = best, forms[best, np.arange(len(raw))]
        packed.append(pack.compress(lines.tobytes()))
    header = struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", header) + _chunk(b"IDAT", b"".join([*packed, pack.flush()])) + _chunk(b"IEND", b"")


#: Rows with a filter of two neighbours that are undone by diagonals; fewer are undone byte by byte.
WAVE_ROWS = 8
#: Bytes of samples, rows' filters included, up to which an image is read.
LARGEST_IMAGE = 1 << 30


def chunks(data: bytes):
    """(kind, data) of each chunk; an error for a wrong signature, length or checksum."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at = 8
    while at < len(data):
        if at + 12 > len(data):
            raise ValueError("a chunk is cut off")
        (size,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + size]
        if at + 12 + size > len(data):
            raise ValueError("a chunk is cut off")
        if struct.unpack_from(">I", data, at + 8 + size)[0] != zlib.crc32(body, zlib.crc32(kind)):
            raise ValueError(f"wrong checksum in {kind!r}")
        yield kind, body
        at += 12 + size
        if kind == b"IEND":
            return
    raise ValueError("no end chunk")


def _by_waves(out: np.ndarray, a: int, b: int, kind: int, channels: int) -> None:
    """Undo filter 3 or 4 of rows a to b: a sample needs those to its left and above, so all of a diagonal go at once."""
    rows, width = b - a, out.shape[1] // channels
    raw = out[a:b].reshape(rows, width, channels).astype(np.int16)
    done = np.zeros((rows + 1, width + 1, channels), np.int16)  # with the row above and a column of zeros
    if a:
        done[0, 1:] = out[a - 1].reshape(width, channels)
    for d in range(rows + width - 1):
        y = np.arange(max(0, d - width + 1), min(rows, d + 1))
        x = d - y
        left, up = done[y + 1, x], done[y, x + 1]
        if kind == 3:
            guess = (left + up) // 2
        else:
            corner = done[y, x]
            p, q, r = np.abs(up - corner), np.abs(left - corner), np.abs(left + up - 2 * corner)
            guess = np.where((p <= q) & (p <= r), left, np.where(q <= r, up, corner))
        done[y + 1, x + 1] = raw[y, x] + guess & 255
    out[a:b] = done[1:, 1:].reshape(rows, -1)


def unfilter(lines: np.ndarray, channels: int) -> np.ndarray:
    """Undo the filters of rows that each start with a filter's number; runs of equal simple filters go at once."""
    filters, out = lines[:, 0], lines[:, 1:].copy()
    if (filters > 4).any():
        raise ValueError("unknown row filter")
    edges = [0, *(np.flatnonzero(np.diff(filters)) + 1).tolist(), len(filters)]
    for a, b in zip(edges, edges[1:], strict=False):
        if a == b:
            continue
        kind = int(filters[a])
        if kind == 1:
            block = out[a:b].reshape(b - a, -1, channels)
            out[a:b] = np.cumsum(block, axis=1, dtype=np.uint8).reshape(b - a, -1)
        elif kind == 2:
            if a:
                out[a] += out[a - 1]
            out[a:b] = np.cumsum(out[a:b], axis=0, dtype=np.uint8)
        elif kind > 2 and b - a >= WAVE_ROWS:
            _by_waves(out, a, b, kind, channels)
        elif kind > 2:
            for y in range(a, b):
                row = out[y].astype(np.int64).tolist()
                above = out[y - 1].astype(np.int64).tolist() if y else [0] * len(row)
                for x in range(len(row)):
                    l, u = row[x - channels] if x >= channels else 0, above[x]
                    if kind == 3:
                        row[x] = row[x] + (l + u) // 2 & 255
                    else:
                        c = above[x - channels] if x >= channels else 0
                        p, q, r = abs(u - c), abs(l - c), abs(l + u - 2 * c)
                        row[x] = row[x] + (l if p <= q and p <= r else u if q <= r else c) & 255
                out[y] = row
    return out


def read_png(data: bytes) -> np.ndarray:
    """8-bit samples (height, width, channels) of a PNG without interlace or palette."""
    header, body = None, []
    for kind, part in chunks(data):
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body.append(part)
    if header is None or header[2] != 8 or header[3] not in _CHANNELS or any(header[4:]):
        raise ValueError("only 8-bit images without palette or interlace are read")
    width, height, channels = header[0], header[1], _CHANNELS[header[3]]
    size = height * (width * channels + 1)
    if size > LARGEST_IMAGE:
        raise ValueError("the image is too large")
    # Inflated to what the header tells and not beyond it.
    engine = zlib.decompressobj()
    raw = engine.decompress(b"".join(body), size + 1)
    if len(raw) == size and not engine.eof:
        raw += engine.decompress(engine.unconsumed_tail, 1)
    if len(raw) != size or not engine.eof:
        raise ValueError("the image data has a wrong size")
    lines = np.frombuffer(raw, np.uint8)
    return unfilter(lines.reshape(height, -1), channels).reshape(height, width, channels)


def _mean_to(values: np.ndarray, n: int) -> np.ndarray:
    """The first axis brought to n rows: means of equal parts, or repeats of the nearest row."""
    m = len(values)
    starts = np.arange(n) * m // n
    if m < n:
        return values[starts]
    return np.add.reduceat(values, starts, axis=0) / np.diff(np.append(starts, m))[:, None]


def cosine_hash(samples: np.ndarray) -> str:
    """16 hex digits: which of the 8 x 8 lowest frequencies exceed the median; the constant one never counts."""
    grey = samples.mean(axis=2)
    small = _mean_to(_mean_to(grey, SIDE).T, SIDE).T
    low = np.round(_COSINES @ (small - small.mean()) @ _COSINES.T, 6).ravel()
    bits = low > np.median(low[1:])
    bits[0] = False
    return np.packbits(bits).tobytes().hex()


def payload_of(text: str | None) -> tuple[bytes, int]:
    """A text's bytes in UTF-8, filled with spaces to a positive multiple of a row, and how many there were before."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + b" " * (max(1, -(-len(data) // ROW)) * ROW - len(data)), len(data)


def as_png(payload: bytes) -> bytes:
    return write_png(np.frombuffer(payload, np.uint8).reshape(-1, WIDTH, CHANNELS))


def media_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): every text stored as a PNG in a binary column. A null text counts as empty."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [payload_of(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "n_bytes": pa.array([n for _, n in made], pa.int64()), "media": pa.array([as_png(p) for p, _ in made], pa.binary())})

    return map_arrow(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")), run, "doc_id long, n_bytes long, media binary")


def media_features(media: DataFrame) -> DataFrame:
    """Read the images of media_column() back: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, problem.

    A damaged image, one whose checksums, data or kind can't be read, has its size and digest and a problem, and nulls
    for all that is read from it. A null image gives nulls. problem is null for a sound image.
    """

    def one(data: bytes | None):
        if data is None:
            return (None,) * 7
        size, digest = len(data), hashlib.sha256(data).hexdigest()
        try:
            samples = read_png(data)
        except (ValueError, zlib.error, struct.error) as error:
            return None, None, None, size, digest, None, str(error)
        payload = samples.tobytes()
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), size, digest, cosine_hash(samples) if samples.size else None, None

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [one(x) for x in batch.column(2).to_pylist()]
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        cols = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "problem"])

    return map_arrow(media.select("doc_id", "n_bytes", "media"), run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, problem string")
