import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.llm import centroids, lexical, line_dedup

SPACE = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# --- line dedup ---------------------------------------------------------------------------------------------------------


def plain_lines(rows, min_docs, min_chars):
    keys = [[lower(x.strip(SPACE)) for x in (t or "").split("\n")] for _, t in rows]
    found = collections.Counter(k for ks in keys for k in set(ks) if len(k) >= min_chars)
    out = []
    for (doc_id, t), ks in zip(rows, keys, strict=True):
        gone = [i for i, k in enumerate(ks) if len(k) >= min_chars and found[k] >= min_docs]
        kept = "\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in gone)
        out.append((doc_id, kept, len(ks), len(gone), max((found[ks[i]] for i in gone), default=None)))
    return sorted(out, key=str)


def line_rows():
    rng = random.Random(3)
    common = ["Sign in", " sign IN\t", "Ä é", "é", "x", "", "  ", "All rights reserved.", "a\x85b", "a b", "\x1c"]
    rows = [(k, "\n".join(rng.choice(common) if rng.random() < 0.6 else f"own {rng.randrange(50)}" for _ in range(rng.randrange(0, 9)))) for k in range(60)]
    return [*rows, (None, "Sign in\nkept"), (None, None), (3, "Sign in"), (3, "Sign in"), (-5, ""), (7, "\n"), (8, "long " * 50_000 + "\nSign in\r\n" + "y\n" * 20_000)]


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
@pytest.mark.parametrize("min_docs, min_chars", [(10, 1), (2, 2), (1, 0)])
def test_lines_equal_a_plain_version(spark, rows, broadcast_bytes, min_docs, min_chars, monkeypatch):
    """By broadcast and by routing, the latter with shards copied for their frequent lines."""
    monkeypatch.setattr(line_dedup, "PROBES_A_COPY", 5)
    given = line_rows()
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(3).withColumns({c: F.lit("x") for c in ("row_file", "row_at", "shard", "lines", "a", "b", "n")})
    made = rows(line_dedup.drop_common_lines(docs, min_docs, min_chars, broadcast_bytes=broadcast_bytes))
    assert sorted(((r["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"], r["most_docs"]) for r in made), key=str) == plain_lines(given, min_docs, min_chars)


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, -1])
def test_lines_of_no_document(spark, rows, broadcast_bytes):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert rows(line_dedup.drop_common_lines(docs, broadcast_bytes=broadcast_bytes)) == []
    one = spark.createDataFrame([(1, None), (2, "a")], "doc_id long, text string")
    assert [(r["n_lines"], r["n_dropped"], r["most_docs"]) for r in rows(line_dedup.drop_common_lines(one, broadcast_bytes=broadcast_bytes))] == [(1, 0, None)] * 2


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash(n):
    """Every hash has a slot of its own and no slot is left; strangers aren't found."""
    pairs = line_dedup._hashes([b"%d" % k for k in range(n)]) if n else np.empty(0, line_dedup._PAIR)
    shard = line_dedup.Shard.build(pairs, np.arange(n) + 10)
    assert sorted(shard.slots(pairs).tolist()) == list(range(n))
    assert shard.probe(pairs).tolist() == list(range(10, n + 10))
    assert not shard.probe(line_dedup._hashes([b"other %d" % k for k in range(3000)])).any()
    assert len(shard.levels) * 64 <= 5 * n + 64 * len(shard.sizes)


# --- centroid clustering ------------------------------------------------------------------------------------------------


def plain_clusters(rows, k, rounds, dimensions):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in order[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    for done in range(rounds + 1):
        of = [min(range(len(centres)), key=lambda c: (far(v, centres[c]), c)) for _, v in kept]
        if done < rounds:
            for c in range(len(centres)):
                own = [v for (_, v), o in zip(kept, of, strict=True) if o == c]
                if own:
                    centres[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    distance = [far(v, centres[o]) for (_, v), o in zip(kept, of, strict=True)]
    inertia = collections.Counter()
    for o, d in zip(of, distance, strict=True):
        inertia[o] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, o, d, inertia[o], sum(distance), digest[o]) for (i, _), o, d in zip(kept, of, distance, strict=True)), key=str)


def clustered(made):
    return sorted(((r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in made), key=str)


@pytest.mark.parametrize("k, rounds, spread", [(8, 10, 1.0), (8, 10, 0.003), (3, 0, 1.0), (12, 4, 100_000.0)])
def test_clusters_equal_plain_rounds(spark, rows, k, rounds, spread):
    """Ties (few different integers), repeats, odd rows; large components, too."""
    rng = random.Random(4)
    given = [(i, [rng.uniform(-spread, spread) for _ in range(4)]) for i in range(150)]
    given += [(500 + i, given[0][1]) for i in range(30)] + [(1, given[1][1]), (1, [0.0] * 4), (None, [0.25] * 4), (None, None), (900, []), (901, [1.0] * 3), (902, [1.0, None, 0.0, 0.0]), (903, [math.nan] * 4), (904, [math.inf, 0.0, 0.0, 0.0])]
    vectors = spark.createDataFrame(given, "vec_id long, embedding array<double>").repartition(3).withColumns({c: F.lit("x") for c in ("v", "cluster", "ids", "drawn")})
    assert clustered(rows(centroids.cluster(vectors, k, rounds, dimensions=4))) == plain_clusters(given, k, rounds, 4)


def test_few_vectors(spark, rows):
    made = lambda given: rows(centroids.cluster(spark.createDataFrame(given, "vec_id long, embedding array<float>"), dimensions=2))
    assert made([]) == [] and made([(1, None)]) == []
    three = [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (None, [-1.0, 0.0])]
    assert clustered(made(three)) == plain_clusters(three, 8, 10, 2)
    with pytest.raises(ValueError):
        centroids.cluster(spark.createDataFrame([], "vec_id long, embedding array<float>"), k=0)


def test_bounds_leave_distances_out():
    """The assignment is that of all distances in every round, with far fewer of them."""
    rng = np.random.default_rng(5)
    v = (rng.normal(0, 30, (4000, 8)) + rng.integers(-500, 500, (20, 8))[rng.integers(0, 20, 4000)]).astype(np.int64)
    c = v[rng.choice(len(v), 20, replace=False)]
    groups, computed = centroids.group_centroids(c), 0
    assert 1 < groups.max() + 1 < 20
    at = centroids.first_bounds(v, c, groups)
    for _ in range(12):
        assert (at.cluster == centroids.squared(v, c).argmin(axis=1)).all()
        old, c = c, c.copy()
        for g in np.unique(at.cluster):
            c[g] = v[at.cluster == g].sum(axis=0) // (at.cluster == g).sum()
        at = centroids.next_bounds(v, at, c, groups, centroids._up(centroids._own(old, c)))
        computed += at.exact
    assert computed < 0.25 * 12 * v.shape[0] * 20


# --- ranked lexical search ----------------------------------------------------------------------------------------------


def plain_ranking(docs, items, k):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t or ""))
    held = [(i, collections.Counter(terms(t)), len(terms(t))) for i, t in docs]
    n, total = sum(1 for x in held if x[2]), sum(x[2] for x in held)
    df = collections.Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc_id, c, length in held:
            m = 75 + 25 * length * n // total if length else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id, score))
        out += [(item, rank, x[3], x[4]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def search_rows():
    rng = random.Random(6)
    words = [f"w{k}" for k in range(40)] + ["Ä", "ä", "é9", "the", "The", "a_b", "x-y"]
    odds = [1 / (k + 1) for k in range(len(words))]
    docs = [(k, " ".join(rng.choices(words, odds, k=rng.randrange(0, 40)))) for k in range(400)]
    docs += [(None, "w30 w31"), (None, "w30 w31"), (5000, None), (5001, ""), (5002, "!!!"), (17, "w30 w31 w32"), (17, "w30 w31 w32"), (6000, "w1 " * 30_000), *((7000 + k, "w0 w35 w36") for k in range(60))]
    items = [(k, " ".join(rng.choices(words, k=rng.randrange(1, 12)))) for k in range(9)]
    return docs, [*items, (1, "w30 w31 w30"), (None, "w35"), (50, None), (51, ""), (52, "unknown"), (53, "w0 w0 w35 THE the")]


@pytest.mark.parametrize("passes, most_terms, block, segment", [(2000, 500_000, 128, 4096), (4, 0, 8, 50)])
def test_ranking_equals_a_plain_version(spark, rows, monkeypatch, passes, most_terms, block, segment):
    """In one pass over the items' terms, and in several over all terms, with many small segments and blocks."""
    for name, value in (("ITEMS_A_PASS", passes), ("MOST_TERMS", most_terms), ("BLOCK", block), ("SEGMENT_ROWS", segment)):
        monkeypatch.setattr(lexical, name, value)
    given, asked = search_rows()
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(3).withColumns({c: F.lit("x") for c in ("item", "rank", "score", "terms", "n", "part")})
    items = spark.createDataFrame(asked, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    for k in (20, 3):
        made = rows(lexical.rank_documents(docs, items, k))
        assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in made), key=str) == plain_ranking(given, asked, k)


def test_search_of_nothing(spark, rows):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert rows(lexical.rank_documents(docs, items)) == rows(lexical.rank_documents(some, items)) == []
    assert rows(lexical.rank_documents(docs, some.toDF("item_id", "text"))) == []
    with pytest.raises(ValueError):
        lexical.rank_documents(docs, items, 0)


def test_blocks_pack_and_are_passed_over():
    rng = random.Random(7)
    for _ in range(200):
        places = np.array(sorted(rng.sample(range(5000), rng.randrange(1, 129))), np.int64)
        tf = np.array([rng.choice([1, 1, 2, 300]) for _ in places], np.int64)
        back = lexical.unpack(memoryview(lexical.pack(places, tf)), int(places[0]))
        assert (back[0] == places).all() and (back[1] == tf).all()
    # Documents alike in length; the item's words are frequent only where the first segment has them.
    counted = [collections.Counter({b"a": 1 + 30 * (k < 50), b"b": 1 + 30 * (k < 50)}) for k in range(4000)]
    seg = lexical.Segment(lexical._segment(list(range(4000)), counted, [62] * 4000, 9000, 62 * 4000))
    best = lexical.Best(20)
    lexical.rank_segment(seg, {b"a": 500, b"b": 700}, best)
    assert best.ids.tolist() == list(range(20)) and len(seg.open) < 20 < len(seg.firsts)
