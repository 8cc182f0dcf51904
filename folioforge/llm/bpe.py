"""BPE encoding and decoding with forced boundaries.

A byte pair that stands inside no token of the vocabulary can never be merged across, so it marks a certain
cut: the merges left and right of it are independent. Each word is cut at such pairs, the fragments are
encoded independently by the vocabulary's merges, and the ids are concatenated. Words are kept with their ids in a
bounded cache of the worker.
A pair that ends a word is looked up among the token ends, since the last byte of a word is a symbol of its own.

The vocabulary is a tokenizer file of the tokenizers library (BPE, byte-level, with an end-of-word suffix). The
driver reads it from a path that is a parameter and sends it to the workers; its size doesn't depend on the data.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE

from .common import map_arrow

#: Below it, lower case, white space and letters are the same in Python and in the library, and NFC changes nothing.
PLAIN_END = 0x250
CACHE = 100_000
#: Longer words are not kept: the cache is bounded in words and in their length.
KEPT_CHARACTERS = 64


def byte_symbols() -> str:
    """The printable character that stands for each byte: itself if printable, else the next one from U+0100."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in keep:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return "".join(out)


def _plain_pattern() -> re.Pattern:
    """The words of a plain text in lower case, as the tokenizer's own pattern finds them; lower case can reach above PLAIN_END."""
    kinds = {k: "".join(re.escape(chr(c)) for c in sorted({*range(0x308), *(ord(x) for c in range(PLAIN_END) for x in chr(c).lower())}) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
    space = "".join(re.escape(chr(c)) for c in range(PLAIN_END) if chr(c).isspace() and not 0x1C <= c <= 0x1F)
    return re.compile(f"[{kinds['L']}]+|'s|'t|'re|'ve|'m|'ll|'d|[{kinds['N']}]|[^{space}{kinds['L']}{kinds['N']}]+")


# How a file's texts are normalized and cut into words, and what else its model does; words are found here in the same way.
WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
SUPPORTED = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": WORDS}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "decoder": None,
}
SUPPORTED_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}


def parsed(source: str) -> dict:
    """A tokenizer file's content; an error if it asks for anything that isn't done here, so that no id is wrong in silence."""
    spec = json.loads(source)
    model = spec.get("model") or {}
    other = [k for k, v in SUPPORTED.items() if spec.get(k) != v] + [f"model.{k}" for k, v in SUPPORTED_MODEL.items() if (model.get(k) or None) != (v or None)]
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") for t in spec.get("added_tokens") or []):
        other.append("added_tokens")
    if other:
        raise ValueError(f"not supported in a tokenizer file: {', '.join(other)}")
    return spec


class _Words(dict):
    """Ids of words; a missing one is encoded. When full, its words become the older generation and are looked up there."""

    def __init__(self, encode):
        self.encode, self.older = encode, {}

    def __missing__(self, word):
        if len(word) > KEPT_CHARACTERS:
            return self.encode(word)
        ids = self.older.get(word) or self.encode(word)
        if len(self) >= CACHE:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids


class Bpe:
    def __init__(self, source: str):
        spec = parsed(source)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.source, self.vocab = source, model["vocab"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.token_of = {i: t for t, i in [*self.vocab.items(), *special.items()]}
        self.special = special
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # One applies the merges to a fragment that ends a word, the other to one inside it, whose last byte is no end.
        self.model = BPE(self.vocab, merges, end_of_word_suffix=self.suffix or None)
        self.model_inside = BPE(self.vocab, merges)
        self.symbols = byte_symbols()
        self.byte_of = {s: b for b, s in enumerate(self.symbols)}
        self.cut_inner, self.cut_last = self._cuts()
        self.plain = _plain_pattern()
        self.beyond = re.compile(f"[^\\x00-{chr(PLAIN_END - 1)}]")
        self.words = _Words(self._word)
        self.library = None
        self.digits_of = {i: str(i) for i in self.token_of}
        # One object an id: the words' ids would else be new ones, which take more room than the words.
        self.same = {i: i for i in self.token_of}

    def _cuts(self) -> tuple[bytes, bytes]:
        """At 256 * first + second byte, 1 for pairs that no token has inside, and for pairs that no token has as its end."""
        inner, last = np.ones((256, 256), bool), np.ones((256, 256), bool)
        for token in self.vocab:
            ends = bool(self.suffix) and token.endswith(self.suffix) and len(token) > len(self.suffix)
            data = [self.byte_of.get(c, -1) for c in (token.removesuffix(self.suffix) if ends else token)]
            for k, (a, b) in enumerate(zip(data, data[1:], strict=False)):
                if a >= 0 and b >= 0:
                    (last if ends and k == len(data) - 2 else inner)[a, b] = False
        return inner.tobytes(), last.tobytes()

    def fragments_of(self, data: bytes) -> list[tuple[bytes, bool]]:
        """(bytes, whether they end the word) between the certain cuts."""
        n, out, start, cut = len(data), [], 0, self.cut_inner
        for k in range(1, n):
            if (cut if k < n - 1 else self.cut_last)[data[k - 1] << 8 | data[k]]:
                out.append((data[start:k], False))
                start = k
        out.append((data[start:], True))
        return out

    def _word(self, word: str) -> tuple[int, ...]:
        return self._bytes(word.encode("utf-8", "surrogatepass"))

    def _bytes(self, data: bytes) -> tuple[int, ...]:
        out: list[int] = []
        for part, ends in self.fragments_of(data):
            model = self.model if ends else self.model_inside
            out += [self.same[t.id] for t in model.tokenize(part.decode("latin-1").translate(self.symbols))]
        return tuple(out)

    def _words_of(self, text: str) -> list[str]:
        if not self.beyond.search(text):
            return self.plain.findall(text.lower())
        if self.library is None:
            self.library = Tokenizer.from_str(self.source)
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        byte_of = self.byte_of
        return [bytes(byte_of[c] for c in piece).decode("utf-8", "surrogatepass") for piece, _ in pieces]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; a null one is empty. Strings of special tokens become their ids."""
        if not text:
            return []
        parts = self.split_special.split(text) if self.split_special and any(map(text.__contains__, self.special)) else [text]
        lookup, out = self.words.__getitem__, []
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out.extend(chain.from_iterable(map(lookup, self._words_of(part))))
        return out

    def decode(self, ids: list[int]) -> str:
        """The tokens of the ids, joined by a space, as the library does for a file without a decoder."""
        return " ".join(map(self.token_of.__getitem__, ids))

    def digits(self, ids: list[int]) -> str:
        return " ".join(map(self.digits_of.__getitem__, ids))


_LOADED: dict[str, Bpe] = {}


def loaded(key: str, source: str) -> Bpe:
    """One instance a worker."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(source)
    return _LOADED[key]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row a document: doc_id, n_tokens, ids (array, if asked for), ids_sha256, decoded_sha256.

    A null text is encoded as an empty one, to no ids. Repeated rows each give a row. Other columns are not read.
    """
    with open(path, encoding="utf-8") as file:
        source = file.read()
    parsed(source)
    key = hashlib.sha256(source.encode()).hexdigest()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = loaded(key, source)
        rows = []
        for text in batch.column(1).to_pylist():
            ids = bpe.encode(text)
            digests = [hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest() for s in (bpe.digits(ids), bpe.decode(ids))]
            rows.append((len(ids), np.array(ids, np.int32) if with_ids else None, *digests))
        n, ids, a, b = zip(*rows, strict=True)
        cols = {"doc_id": batch.column(0), "n_tokens": pa.array(n, pa.int64())}
        if with_ids:
            cols["ids"] = pa.array(list(ids), pa.list_(pa.int32()))
        cols |= {"ids_sha256": pa.array(a, pa.string()), "decoded_sha256": pa.array(b, pa.string())}
        return pa.RecordBatch.from_pydict(cols)

    schema = f"doc_id long, n_tokens long, {'ids array<int>, ' if with_ids else ''}ids_sha256 string, decoded_sha256 string"
    return map_arrow(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")), run, schema)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every document; null and empty texts have no ids."""
    return encode_decode(docs, path, id_col, text_col).select("doc_id", "ids")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded) of every row of ids; null ids decode to an empty text, an unknown id is an error."""
    with open(path, encoding="utf-8") as file:
        source = file.read()
    key = hashlib.sha256(source.encode()).hexdigest()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = loaded(key, source)
        return pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "decoded": pa.array([bpe.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())})

    return map_arrow(encoded.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{ids_col}`").cast("array<int>").alias("ids")), run, "doc_id long, decoded string")
