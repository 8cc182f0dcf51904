"""License scans: an exact set-similarity join of text blocks with licence templates.

A template is a set of words: a phrase, a notice or the whole text of a licence. A text is cut into overlapping blocks of
words, twice as long as the templates they are for, in classes of lengths that double. A pair (block, template) is a
result if the block holds at least the template's threshold of the template's words (containment). Words
outside all templates cannot add to an overlap, so both sides are first reduced to the templates' vocabulary.
Both sides are then ordered by one global order, the words' document frequency over the whole corpus, rarest
first, and the join runs three filters before it counts an overlap:

* prefix: with a = ceil(threshold * |template|), the first |template| - a + 1 words of the template and the
  first |block| - a + 1 words of the block must share a word,
* length: a block with fewer than a words cannot qualify,
* positions: with the first shared words at i and j, 1 + min(|template| - i - 1, |block| - j - 1) >= a.

The template side is a broadcast of a proven size: it grows with the list of templates alone.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

# The base phrases with their labels.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Words of well-known licence notices, their labels, and the share of the words that a block must hold.
NOTICES = (
    ("gnu general public license version 3", "gpl-3", 1.0),
    ("gnu general public license version 2", "gpl-2", 1.0),
    ("gnu lesser general public license", "lgpl", 1.0),
    ("gnu affero general public license", "agpl", 1.0),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit", 0.8),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd", 0.8),
    ("this source code form is subject to the terms of the mozilla public license", "mpl", 0.8),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc", 0.8),
    ("this is free and unencumbered software released into the public domain", "unlicense", 0.8),
    ("creative commons attribution sharealike", "cc-by-sa", 1.0),
    ("creative commons zero public domain dedication", "cc0", 0.8),
)

# Whole texts of licences, their labels, and the share of their different words that a block must hold.
TEXTS = (
    (
        "mit", 0.9,
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so "
        "subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement "
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
        "arising from out of or in connection with the software or the use or other dealings in the software",
    ),
    (
        "bsd", 0.9,
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution "
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to "
        "the implied warranties of merchantability and fitness for a particular purpose are disclaimed "
        "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to "
        "procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability "
        "whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    ),
    (
        "isc", 0.9,
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies "
        "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness "
        "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits "
        "whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    ),
    (
        "apache-2", 0.9,
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 "
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    ),
    (
        "unlicense", 0.9,
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software "
        "either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    ),
)

#: Bytes of words lower-cased, all others to a space: letters and digits of ASCII, and all bytes of other characters.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: The least stride of blocks.
STRIDE = 32


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


@dataclass(frozen=True)
class Template:
    words: tuple[bytes, ...]
    label: str
    threshold: float
    exact: bool  # a base phrase: found blocks are searched for the words in a row

    @property
    def needed(self) -> int:
        return max(1, math.ceil(self.threshold * len(set(self.words)) - 1e-9))

    @property
    def stride(self) -> int:
        """The blocks for it start at every so many words and have twice as many: STRIDE, doubled until the template fits.

        Each run of up to stride + 1 words lies in the block of its first word.
        """
        return STRIDE << max(0, (len(self.words) - 1).bit_length() - STRIDE.bit_length() + 1)


def templates(phrases=BASE_PHRASES, notices=NOTICES, texts=TEXTS) -> list[Template]:
    """Base phrases need all their words, a notice or a whole text its own share of them; of any length, but none is empty."""
    out = [Template(tuple(p.encode().split()), label, 1.0, True) for p, label in phrases]
    out += [Template(tuple(p.encode().split()), label, share, False) for p, label, share in notices]
    out += [Template(tuple(p.encode().split()), label, share, False) for label, share, p in texts]
    if any(not t.words for t in out):
        raise ValueError("a template has a word at least")
    return out


def word_frequencies(docs: DataFrame, vocabulary: set[bytes], text_col: str = "text") -> dict[bytes, int]:
    """In how many documents each word of the vocabulary stands; the result is as large as the vocabulary at most."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: Counter = Counter()
        for text in batch.column(0).to_pylist():
            found.update(vocabulary.intersection(words_of(text)))
        return pa.RecordBatch.from_arrays([pa.array(list(found.keys()), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

    counted = map_arrow(docs.select(F.col(f"`{text_col}`").cast("string").alias("text")), count, "word binary, n long")
    return {bytes(r.word): r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


class Index:
    """Templates ordered by global frequency, with an inverted index of their prefixes."""

    def __init__(self, items: list[Template], frequency: dict[bytes, int]):
        vocabulary = {w for t in items for w in t.words}
        self.rank = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w)))}
        self.items = items
        self.sorted = [sorted(self.rank[w] for w in set(t.words)) for t in items]
        self.probes: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for k, (t, ranks) in enumerate(zip(items, self.sorted, strict=True)):
            for i, r in enumerate(ranks[: len(ranks) - t.needed + 1]):
                self.probes.setdefault(t.stride, {}).setdefault(r, []).append((k, i))
        by_rank = {r: w for w, r in self.rank.items()}
        self.any_prefix_word = frozenset(by_rank[r] for probe in self.probes.values() for r in probe)
        self.prefix_words = {stride: frozenset(by_rank[r] for r in probe) for stride, probe in self.probes.items()}

    def join(self, block: list[int], stride: int = STRIDE) -> list[tuple[int, int]]:
        """(template, overlap) of all templates of a stride whose containment in a block, sorted ranks, meets the threshold."""
        out, seen, members, probe = [], set(), set(block), self.probes.get(stride, {})
        for j, r in enumerate(block):
            for k, i in probe.get(r, ()):
                if k in seen:
                    continue
                need, ranks = self.items[k].needed, self.sorted[k]
                if len(block) < need or j > len(block) - need:  # length, block prefix
                    continue
                seen.add(k)
                if 1 + min(len(ranks) - i - 1, len(block) - j - 1) < need:  # positions of the first shared word
                    continue
                overlap = sum(x in members for x in ranks)
                if overlap >= need:
                    out.append((k, overlap))
        return out

    def scan(self, words: list[bytes]) -> list[tuple[int, int, float, list[int]]]:
        """(template, first word of the block, containment, starts of the words in a row) of every result in a text."""
        if self.any_prefix_word.isdisjoint(words):
            return []
        strides = [stride for stride, first in self.prefix_words.items() if not first.isdisjoint(words)]
        rank, out = self.rank, []
        hits = [(p, rank[w]) for p, w in enumerate(words) if w in rank]
        for stride in strides:
            blocks: dict[int, set[int]] = {}
            for p, r in hits:
                b = p // stride
                blocks.setdefault(b, set()).add(r)
                if b:
                    blocks.setdefault(b - 1, set()).add(r)
            for b in sorted(blocks):
                for k, overlap in self.join(sorted(blocks[b]), stride):
                    t, starts = self.items[k], []
                    if t.exact:
                        n = len(t.words)
                        first = t.words[0]
                        starts = [p for p in range(b * stride, min((b + 1) * stride, len(words) - n + 1)) if words[p] == first and tuple(words[p : p + n]) == t.words]
                    out.append((k, b * stride, overlap / len(self.sorted[k]), starts))
        return out


def build_index(docs: DataFrame, items: list[Template] | None = None, text_col: str = "text") -> Index:
    items = templates() if items is None else items
    return Index(items, word_frequencies(docs, {w for t in items for w in t.words}, text_col))


def license_blocks(docs: DataFrame, items: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every result of the join: (doc_id, block_start, label, containment, starts).

    Null and empty texts have no blocks. Repeated rows each give their own results. Other columns are not read.
    """
    index = build_index(docs, items, text_col)

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(d, b, index.items[k].label, c, s) for d, text in zip(*map(pa.Array.to_pylist, batch.columns), strict=True) for k, b, c, s in index.scan(words_of(text))]
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "block_start", "label", "containment", "starts"])

    return map_arrow(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")), scan, "doc_id long, block_start long, label string, containment double, starts array<long>")


def license_scan(docs: DataFrame, items: list[Template] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: its words, places of base phrases, and labels.

    doc_id, n_words, n_base (all places), first_word and last_word (smallest and largest start, null without
    places), base_labels and labels (distinct, sorted, comma-joined; labels has the join's too), score (largest
    containment, 0 without results). A null text counts as empty. Repeated rows each give a row. No other column is read.
    """
    index = build_index(docs, items, text_col)
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]

    def one(doc_id, text):
        words = words_of(text)
        found = index.scan(words)
        starts = [p for _, _, _, s in found for p in s]
        base = {index.items[k].label for k, _, _, s in found if s}
        more = base | {index.items[k].label for k, _, _, _ in found if not index.items[k].exact}
        score = max((c for k, _, c, s in found if s or not index.items[k].exact), default=0.0)
        return doc_id, len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(more)), score

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [one(*x) for x in zip(*map(pa.Array.to_pylist, batch.columns), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return map_arrow(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")), scan, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
