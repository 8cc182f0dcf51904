"""Language ID by hierarchical discrimination.

A text's hashed byte trigrams are first told apart by language family, then, within the family, by language. Both
levels are one-versus-one linear support vector machines with squared hinge loss, trained here on all labelled documents:
the workers turn whole texts into features, which they keep on disk, and sum up losses and gradients over them; the driver
takes the steps of limited-memory BFGS and holds what belongs to the machines alone.
"""

from __future__ import annotations

import itertools
import re
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, give_back, map_arrow

# Families of languages by code. A language that isn't named is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb"),
    "romance": ("fr", "es", "pt", "it", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "mr", "ne", "bn", "ur"),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}
DIMENSIONS = 4096
UNDETERMINED = "und"
#: A text may have this share of the margin that ordinary documents have; and how many of them it takes to know theirs.
LOOSENESS, LEAST_CALIBRATION = 0.5, 25
#: Languages that are learned: all pairs of a family get a machine.
MAX_LANGUAGES = 64
#: What a machine's two classes weigh in its loss, half of it each, against half its squared length; machines that learn at a time, which bounds what the driver holds of them.
STRENGTH, BLOCK = 10_000.0, 512
_LETTER = re.compile(r"[^\W\d_]")
#: ASCII but letters to a space; other bytes stay.
_LETTERS = np.array([c if c >= 128 or 65 <= c <= 90 or 97 <= c <= 122 else 32 for c in range(256)], np.uint8)


def family_of(language: str) -> str:
    return _FAMILY_OF.get(language.lower().replace("_", "-").split("-")[0], language)


def has_letter(text: str | None) -> bool:
    return bool(text) and bool(_LETTER.search(text))


def features(text: str) -> np.ndarray:
    """Square roots of the counts of hashed byte trigrams of the whole text in lower case, of length 1; a last constant."""
    data = _LETTERS[np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)]
    data = data[np.append(True, (data[1:] != 32) | (data[:-1] != 32))].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(DIMENSIONS + 1, np.float32)
    hashes = data[:-2] * np.uint32(0x9E3779B1) + data[1:-1] * np.uint32(0x85EBCA6B) + data[2:] * np.uint32(0xC2B2AE35)
    out = np.zeros(DIMENSIONS + 1, np.float32)
    out[:-1] = np.sqrt(np.bincount(hashes >> np.uint32(20), minlength=DIMENSIONS))
    out /= max(np.linalg.norm(out), 1e-9)
    out[-1] = 0.1
    return out


def pack(x: np.ndarray) -> bytes:
    """Places of a text's features that aren't 0, then these as half floats."""
    at = np.flatnonzero(x)
    return at.astype(np.uint16).tobytes() + x[at].astype(np.float16).tobytes()


def unpack(packed: list[bytes]) -> np.ndarray:
    out = np.zeros((len(packed), DIMENSIONS + 1), np.float32)
    for row, data in zip(out, packed, strict=True):
        row[np.frombuffer(data[: len(data) // 2], np.uint16)] = np.frombuffer(data[len(data) // 2 :], np.float16)
    return out


@dataclass
class Task:
    """What machines are to learn: a row a machine, a column a class."""

    signs: np.ndarray  # 1 or -1 for the classes of either side, else 0
    costs: np.ndarray  # of a document's loss
    apart: np.ndarray  # whether a machine leaves out documents that are kept for trying it

    @classmethod
    def of(cls, signs: np.ndarray, counts: np.ndarray, apart: bool = False) -> Task:
        """From the number of documents a class; both sides of a machine weigh the same, however many documents they have."""
        sides = [np.where(signs == side, STRENGTH / 2 / np.maximum((signs == side) @ counts, 1)[:, None], 0) for side in (1, -1)]
        return cls(signs, sides[0] + sides[1], np.full(len(signs), apart))

    def only(self, machines: list[int]) -> Task:
        return Task(self.signs[machines], self.costs[machines], self.apart[machines])

    def sums(self, weights: np.ndarray, x: np.ndarray, classes: np.ndarray, tried: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every machine's loss over documents, and its gradient."""
        loss, gradient = np.zeros(len(weights)), np.zeros(weights.shape)
        for k in np.unique(classes):
            mine, rows = np.flatnonzero(self.signs[:, k]), classes == k
            own, sign, cost = x[rows], self.signs[mine, k].astype(np.float32), self.costs[mine, k]
            slack = np.maximum(1 - sign * (own @ weights[mine].T), 0)
            slack[np.ix_(tried[rows], self.apart[mine])] = 0
            loss[mine] += cost * np.square(slack, dtype=np.float64).sum(0)
            gradient[mine] -= (2 * cost * sign)[:, None] * (slack.T @ own)
        return loss, gradient


class Descent:
    """Limited-memory BFGS with halved steps for one machine: wants the loss and gradient at `at`, until it is done."""

    def __init__(self, memory: int = 6, tolerance: float = 1e-3) -> None:
        self.at = self.best = np.zeros(DIMENSIONS + 1, np.float32)
        self.loss, self.gradient, self.first = np.inf, None, 0.0
        self.direction, self.step, self.slope = None, 1.0, 0.0
        self.past, self.tolerance, self.done = deque(maxlen=memory), tolerance, False

    def tell(self, loss: float, gradient: np.ndarray) -> None:
        """Documents' loss and gradient at `at`; the machine's length is added here."""
        w = self.at.astype(np.float64)
        loss, gradient = float(loss + w @ w / 2), gradient + w
        if self.gradient is not None and loss > self.loss + 1e-4 * self.step * self.slope:
            self.step /= 2
            self.done = self.step < 1e-6  # as good as single floats can tell
        else:
            if self.gradient is None:
                self.first = float(np.linalg.norm(gradient))
            elif (moved := w - self.best) @ (turned := gradient - self.gradient) > 1e-12:
                self.past.append((moved.astype(np.float32), turned.astype(np.float32)))
            self.best, self.loss, self.gradient, self.step = self.at, loss, gradient, 1.0
            self.done = float(np.linalg.norm(gradient)) <= self.tolerance * self.first
            self.direction = -self._turn(gradient)
            self.slope = float(self.direction @ gradient)
        if not self.done:
            self.at = (self.best + self.step * self.direction).astype(np.float32)

    def _turn(self, gradient: np.ndarray) -> np.ndarray:
        if not self.past:
            return gradient / max(1.0, float(np.linalg.norm(gradient)))
        out, shares = gradient.copy(), []
        for moved, turned in reversed(self.past):
            shares.append((moved @ out) / float(moved @ turned))
            out -= shares[-1] * turned
        moved, turned = self.past[-1]
        out *= float(moved @ turned) / float(turned @ turned)
        for (moved, turned), share in zip(self.past, reversed(shares), strict=True):
            out += (share - (turned @ out) / float(moved @ turned)) * moved
        return out


def learn(task: Task, sums: Callable[[Task, np.ndarray], tuple[np.ndarray, np.ndarray]], passes: int = 200) -> np.ndarray:
    """Weights of a task's machines, from losses and gradients over all documents, a pass over these a step.

    A machine is done when its gradient is a thousandth of what it was at first, or when no step makes its loss less.
    More than BLOCK machines learn in blocks, one after another.
    """
    if len(task.signs) > BLOCK:
        return np.concatenate([learn(task.only(list(range(k, min(k + BLOCK, len(task.signs))))), sums, passes) for k in range(0, len(task.signs), BLOCK)])
    machines = [Descent() for _ in task.signs]
    for _ in range(passes):
        going = [k for k, m in enumerate(machines) if not m.done]
        if not going:
            break
        loss, gradient = sums(task.only(going), np.array([machines[k].at for k in going]))
        for k, own_loss, own_gradient in zip(going, loss, gradient, strict=True):
            machines[k].tell(own_loss, own_gradient)
    return np.array([m.best for m in machines], np.float32).reshape(len(machines), DIMENSIONS + 1)


@dataclass
class OneVersusOne:
    """Classes with a machine for every two of them: votes decide, then the sum of margins."""

    classes: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray  # a row for each pair

    @classmethod
    def empty(cls, classes: list[str]) -> OneVersusOne:
        """Machines that have yet to learn."""
        pairs = list(itertools.combinations(range(len(classes)), 2))
        return cls(classes, pairs, np.zeros((len(pairs), DIMENSIONS + 1), np.float32))

    def signs(self, of: list[str]) -> np.ndarray:
        """A row a machine: 1 and -1 where a column, of the given class, is its first or second one."""
        place = np.array([self.classes.index(c) if c in self.classes else -1 for c in of])
        return np.array([(place == a).astype(np.int8) - (place == b) for a, b in self.pairs], np.int8).reshape(len(self.pairs), len(of))

    @classmethod
    def train(cls, samples: dict[str, np.ndarray]) -> OneVersusOne:
        """From features by class, all at hand."""
        out = cls.empty(sorted(samples))
        x = np.concatenate([samples[c] for c in out.classes]).astype(np.float32, copy=False)
        classes = np.repeat(np.arange(len(out.classes)), [len(samples[c]) for c in out.classes])
        none = np.zeros(len(x), bool)
        out.weights = learn(Task.of(out.signs(out.classes), np.bincount(classes)), lambda task, weights: task.sums(weights, x, classes, none))
        return out

    def decide(self, x: np.ndarray) -> tuple[str, float]:
        """The class, and its margin against the nearest other class: negative where that one beats it, infinite if there is none."""
        if not self.pairs:
            return self.classes[0], np.inf
        margins, votes, sums, least = self.weights @ x, [0] * len(self.classes), [0.0] * len(self.classes), [np.inf] * len(self.classes)
        for (a, b), m in zip(self.pairs, margins.tolist(), strict=True):
            votes[a if m >= 0 else b] += 1
            sums[a], sums[b] = sums[a] + m, sums[b] - m
            least[a], least[b] = min(least[a], m), min(least[b], -m)
        best = max(range(len(self.classes)), key=lambda k: (votes[k], sums[k], -k))
        return self.classes[best], least[best]

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        """The class, and 0.5 to 1 from its margin; 1 if there is no other class."""
        found, margin = self.decide(x)
        return found, _score(margin)


def _score(margin: float) -> float:
    return float(1 / (1 + np.exp(-3.0 * max(margin, 0.0))))


@dataclass
class Model:
    family: OneVersusOne | None
    within: dict[str, OneVersusOne]
    least_margin: float = -np.inf  # below it, a text is in no language that was learned

    @classmethod
    def empty(cls, languages: list[str]) -> Model:
        """Machines of both levels that have yet to learn."""
        families: dict[str, list[str]] = {}
        for lang in sorted(languages):
            families.setdefault(family_of(lang), []).append(lang)
        return cls(OneVersusOne.empty(sorted(families)), {f: OneVersusOne.empty(known) for f, known in families.items()})

    def signs(self, languages: list[str]) -> np.ndarray:
        """Those of all machines, in the order of put()."""
        return np.concatenate([self.family.signs([family_of(lang) for lang in languages]), *(m.signs(languages) for m in self.within.values())])

    def put(self, weights: np.ndarray) -> Model:
        for machine in (self.family, *self.within.values()):
            machine.weights, weights = weights[: len(machine.pairs)], weights[len(machine.pairs) :]
        return self

    def margin(self, x: np.ndarray) -> float:
        """The lesser of the margins at both levels, of a text's features."""
        family, margin = self.family.decide(x)
        return min(margin, self.within[family].decide(x)[1])

    def identifies(self, text: str | None) -> bool:
        """Whether a text has a letter and a margin of least_margin or more; the former alone if nothing was learned."""
        return has_letter(text) and (self.family is None or self.margin(features(text)) >= self.least_margin)

    def predict(self, text: str | None) -> tuple[str, float]:
        """A learned language and a score from 0 to 1; `und` and 0 for a text that is null or has no letter, or if nothing was learned."""
        if self.family is None or not has_letter(text):
            return UNDETERMINED, 0.0
        x = features(text)
        family, p = self.family.predict(x)
        language, q = self.within[family].predict(x)
        return language, p * q


def least_margin(tried: DataFrame, n: int, model: Model) -> float:
    """LOOSENESS times the margin that all but one in a hundred of n documents have, which the model's machines weren't trained on.

    Minus infinity, so that nothing is rejected, if there are fewer than LEAST_CALIBRATION. The margin is found among those of all
    documents, as single floats: first the upper half of its bits, by counts of each, then the lower one among those that share it.
    """
    if n < LEAST_CALIBRATION:
        return -np.inf

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bits = np.array([model.margin(x) for x in unpack(batch.column("x").to_pylist())], np.float32).view(np.int32).astype(np.int64)
        return pa.RecordBatch.from_pydict({"key": pa.array(np.where(bits < 0, -(bits & 0x7FFFFFFF), bits))})  # in the order of the floats

    keys = map_arrow(tried, run, "key long")
    upper, place = _at_place(keys.select(F.shiftright("key", 16).alias("key")), n // 100)
    lower, _ = _at_place(keys.where(F.shiftright("key", 16) == upper).select(F.col("key").bitwiseAND(F.lit(0xFFFF)).alias("key")), place)
    key = (upper << 16) + lower
    found = float(np.uint32(-key | 0x80000000 if key < 0 else key).view(np.float32))
    return min(found, found * LOOSENESS) if np.isfinite(found) else -np.inf


def _at_place(keys: DataFrame, place: int) -> tuple[int, int]:
    """The key at a place (from 0) in their order, and the place among its equals; there are at most 65,536 different keys."""
    for key, n in sorted((r.key, r.n) for r in keys.groupBy("key").agg(F.count("*").alias("n")).collect()):
        if place < n:
            return key, place
        place -= n
    raise ValueError("fewer keys than places")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of the id as text leaves 1 when divided by 3; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def labelled_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_languages: int = MAX_LANGUAGES) -> tuple[DataFrame, dict[str, int]]:
    """doc_id, text and lang of the documents to learn from, and how many there are of each language that is learned.

    Of more than max_languages values of lang the most frequent are learned, equal ones in their order; the others' documents
    teach nothing and are predicted as one of those learned.
    """
    labelled = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"), held_out(id_col).alias("held_out")).where(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    return labelled, {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()}


def training_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 500, max_languages: int = MAX_LANGUAGES) -> DataFrame | None:
    """lang, draw and x, features as half floats, of at most per_language documents a language; None if nothing is labelled.

    For a look at part of a table: train() takes all of it, unless it is given a per_language. Documents are drawn by a hash of
    id and text, so that rows without an id, or with a common one, are drawn like others. The executors cut to per_language,
    after rows that repeat another are left out.
    """
    labelled, counts = labelled_documents(docs, id_col, text_col, lang_col, max_languages)
    if not counts:
        return None
    out_of = 1 << 30
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(out_of))
    limits = F.create_map(*[F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, min(out_of, round(out_of * 1.1 * per_language / n)))])
    sample = labelled.where(draw < limits[F.col("lang")]).select("lang", draw.alias("draw"), "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, draws, texts = map(pa.Array.to_pylist, batch.columns)
        keep = [k for k, t in enumerate(texts) if has_letter(t)]
        return pa.RecordBatch.from_arrays([pa.array([lang[k] for k in keep], pa.string()), pa.array([draws[k] for k in keep], pa.int64()), pa.array([features(texts[k]).astype(np.float16).tobytes() for k in keep], pa.binary())], ["lang", "draw", "x"])

    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "x"))
    return map_arrow(sample, run, "lang string, draw long, x binary").distinct().withColumn("place", place).where(F.col("place") <= per_language).drop("place")


def training_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_languages: int = MAX_LANGUAGES) -> DataFrame | None:
    """lang, tried and x, packed features, of all documents to learn from, repeated ones as often as they are; None if nothing is labelled.

    Tried are a quarter of the different texts, by their hash; texts without a letter are left out.
    """
    labelled, counts = labelled_documents(docs, id_col, text_col, lang_col, max_languages)
    if not counts:
        return None

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        keep = [k for k, t in enumerate(texts) if has_letter(t)]
        own = batch.select(["lang", "tried"]).take(pa.array(keep, pa.int64()))
        return pa.RecordBatch.from_arrays([*own.columns, pa.array([pack(features(texts[k])) for k in keep], pa.binary())], ["lang", "tried", "x"])

    return map_arrow(labelled.where(F.col("lang").isin(sorted(counts))).select("lang", _quarter("text").alias("tried"), "text"), run, "lang string, tried boolean, x binary")


def _quarter(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(4)) == 3


def distributed_sums(rows: DataFrame, languages: list[str], task: Task, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Task.sums() over all rows of training_features(), a task a core; their sums meet by machine."""
    bound_batches(rows.sparkSession)
    place = {lang: k for k, lang in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, gradient = np.zeros(len(weights)), np.zeros(weights.shape)
        for batch in batches:
            if batch.num_rows:
                lang, tried, packed = map(pa.Array.to_pylist, batch.columns)
                more = task.sums(weights, unpack(packed), np.array([place[v] for v in lang]), np.array(tried))
                loss, gradient = loss + more[0], gradient + more[1]
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(weights)), pa.int32()), pa.array([part] * len(weights), pa.int32()), pa.array(loss), pa.array([g.astype(np.float32).tobytes() for g in gradient], pa.binary())], ["machine", "part", "loss", "gradient"])
        give_back()

    def add(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")  # so that a run repeated gives the same sum
        total = np.sum([np.frombuffer(g, np.float32) for g in group.column("gradient").to_pylist()], axis=0, dtype=np.float64)
        return pa.table({"machine": group.column("machine")[:1], "loss": pa.array([float(np.sum(group.column("loss").to_numpy()))]), "gradient": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    parts = rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, "machine int, part int, loss double, gradient binary")
    found = sorted(parts.groupBy("machine").applyInArrow(add, "machine int, loss double, gradient binary").collect(), key=lambda r: r.machine)
    return np.array([r.loss for r in found]), np.array([np.frombuffer(r.gradient, np.float32) for r in found])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int | None = None, max_languages: int = MAX_LANGUAGES) -> Model:
    """Learn from text and lang of all documents that aren't held out, of each of max_languages languages.

    Texts without a letter and null languages teach nothing. An empty table gives a model that answers `und`. The model's
    least_margin is fitted on a quarter of the different texts, all of them, with machines that learn from the other texts only.
    Where all of a language's texts are in that quarter, these machines learn from them. With per_language, all this is done
    on a training_sample() of that many documents a language.
    """
    if per_language is None:
        rows = training_features(docs, id_col, text_col, lang_col, max_languages)
    elif (rows := training_sample(docs, id_col, text_col, lang_col, per_language, max_languages)) is not None:
        packed = lambda batch: pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("tried"), pa.array([pack(np.frombuffer(x, np.float16)) for x in batch.column("x").to_pylist()], pa.binary())], ["lang", "tried", "x"])
        rows = map_arrow(rows.select("lang", _quarter("x").alias("tried"), "x"), packed, "lang string, tried boolean, x binary")
    if rows is None:
        return Model(None, {})
    kept = rows.persist(StorageLevel.DISK_ONLY)
    try:
        counts = {(r.lang, r.tried): r.n for r in kept.groupBy("lang", "tried").agg(F.count("*").alias("n")).collect()}
        if not counts:
            return Model(None, {})
        languages = sorted({lang for lang, _ in counts})
        split = [lang for lang in languages if (lang, False) in counts]
        n_tried = sum(counts.get((lang, True), 0) for lang in split)
        every = np.array([counts.get((lang, False), 0) + counts.get((lang, True), 0) for lang in languages])
        learned = np.array([counts.get((lang, False), 0) or counts[lang, True] for lang in languages])
        model = Model.empty(languages)
        task = Task.of(model.signs(languages), every)
        if not len(task.signs):
            return model
        used = kept.withColumn("tried", F.col("tried") & F.col("lang").isin(split))
        calibrated = n_tried >= LEAST_CALIBRATION
        if calibrated:
            more = Task.of(task.signs, learned, apart=True)
            task = Task(*(np.concatenate(x) for x in ((task.signs, more.signs), (task.costs, more.costs), (task.apart, more.apart))))
        weights = learn(task, lambda own, at: distributed_sums(used, languages, own, at))
        if calibrated:
            half = len(weights) // 2
            model.least_margin = least_margin(used.where("tried").select("x"), n_tried, Model.empty(languages).put(weights[half:]))
            weights = weights[:half]
        return model.put(weights)
    finally:
        kept.unpersist()


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, held_out, lang_pred, score. Only the text decides; repeated rows each give a row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [model.predict(t) for t in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "held_out": batch.column(1), "lang_pred": pa.array([x for x, _ in found], pa.string()), "score": pa.array([s for _, s in found], pa.float64())})

    return map_arrow(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(f"`{text_col}`").cast("string").alias("text")), run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", min_margin: float | None = None) -> DataFrame:
    """The rows of docs, all columns as they are, whose language is identified.

    Rejected are texts that are null or have no letter, and those with a margin below min_margin, by default the model's
    own, at one of the levels: they are like no language that was learned. With a model that has learned nothing, or a
    single language, or from too few documents to fit a margin, only the former go.
    """
    if min_margin is not None:
        model = replace(model, least_margin=min_margin)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
        return batch.filter(pa.array([model.identifies(t) for t in texts], pa.bool_()))

    return map_arrow(docs, run, docs.schema)
