"""N-gram join, vector dedup and components against all-pairs twins."""

from __future__ import annotations

import math
import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.llm import ngram_join, vector_dedup
from flowlake.llm.components import components


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# --- components --------------------------------------------------------------

def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(5, 5), (200, 201), (201, 200)]
    edges += [(rng.randint(300, 420), rng.randint(300, 420)) for _ in range(90)]
    rng.shuffle(edges)
    want = union([e for e in edges if e[0] != e[1]], {n for e in edges if e[0] != e[1] for n in e})
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- n-gram join -------------------------------------------------------------

def plain_sets(texts):
    out = []
    for t in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        out.append(set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)})
    return out


def plain_join(rows):
    sets = plain_sets([t for _, t in rows])
    links = [(rows[i][0], rows[j][0]) for i, j in combinations(range(len(rows)), 2)
             if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    root = union(links, [i for i, _ in rows])
    return {i: (len(s), root[i]) for (i, _), s in zip(rows, sets)}


def varied_texts(rng):
    vocabulary = [f"w{k}" for k in range(400)] + ["É", "é", "The", "the"]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage = words(60)
    texts = ["", None, " \n ", "one", "one two", "One  two", "a b c d", "a b c d e", "A\tB c\x0bd e", "a b c d e f"]
    for _ in range(40):
        base = words(rng.choice([5, 8, 20, 60, 200]))
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                at, what = rng.randrange(len(copy)), rng.random()
                if what < .4:
                    copy[at] = rng.choice(vocabulary)
                elif what < .7:
                    copy.insert(at, rng.choice(vocabulary))
                elif len(copy) > 1:
                    del copy[at]
            texts.append(rng.choice([" ", "\n", "  "]).join(copy))
        texts.append(" ".join(words(80) + passage + words(80)))
        texts.append(" ".join(base + base[:len(base) // 3]))
    return texts


@pytest.mark.parametrize("seed,chunk,hot_slice", [(1, None, 64), (2, None, 1), (3, 800, 2)])
def test_ngram_join_equals_all_pairs(spark, monkeypatch, seed, chunk, hot_slice):
    if chunk:
        monkeypatch.setattr(ngram_join, "CHUNK_ELEMENTS", chunk)
    monkeypatch.setattr(ngram_join, "HOT_SLICE", hot_slice)  # 1: every shared element is hot
    rng = random.Random(seed)
    texts = varied_texts(rng)
    ids = rng.sample(range(10_000), len(texts))
    rows = list(zip(ids, texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("fp", F.lit("x"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join_documents(df).collect()}
    assert got == plain_join(rows)


def test_ngram_join_of_copies_nulls_and_nothing(spark):
    schema = "doc_id long, text string"
    text = "one two three four five six seven"
    df = spark.createDataFrame([(5, text), (3, text), (3, text), (None, text), (9, None), (None, None)], schema)
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in ngram_join.join_documents(df).collect()
                 if r["doc_id"] is not None)
    assert got == [(3, 3, 3), (3, 3, 3), (5, 3, 3), (9, 0, 9)]
    assert ngram_join.join_documents(df.limit(0)).collect() == []


def test_t_occurrence_connects_all_linked_sets():
    rng = random.Random(7)
    for _ in range(60):
        hot = rng.sample(range(1000), 30)
        sets = []
        for _ in range(rng.randint(2, 25)):
            base = rng.sample(range(1000), rng.randint(1, 40)) + rng.sample(hot, rng.randint(0, 30))
            sets.append(np.unique(base))
            if rng.random() < .6:
                sets.append(np.unique(base[:-max(1, len(base) // 8)] + rng.sample(range(1000), len(base) // 10)))
        linked = [(i, j) for i, j in combinations(range(len(sets)), 2)
                  if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j])) and len(sets[i])]
        sets = [s.astype(np.int64) for s in sets]
        found = ngram_join.t_occurrence_links(sets)
        assert all((min(p), max(p)) in linked for p in found)
        assert union(found, range(len(sets))) == union(linked, range(len(sets)))
        side = np.arange(len(sets)) % 2
        cross = [p for p in linked if side[p[0]] != side[p[1]]]
        assert union(ngram_join.t_occurrence_links(sets, side), range(len(sets))) == union(cross, range(len(sets)))


def test_core_and_prefix_bounds_hold_for_all_sizes():
    for n in range(1, 120):
        for m in range(n, math.floor(n / 0.75) + 1):
            for common in range(ngram_join.required(n, m), n + 1):
                k = ngram_join.common_needed(n)
                assert k <= common
                assert n - common + k <= ngram_join.core_size(n) <= max(ngram_join.prefix_size(n), 1)
                assert m - common + k <= ngram_join.prefix_size(m)
            assert ngram_join.common_needed(math.ceil(0.75 * m)) <= ngram_join.common_needed(n)


def test_word_hashes_match_words_across_chunk_edges():
    from flowlake.llm.common import word_hashes

    rng = random.Random(8)
    texts = ["".join(rng.choice("ab \n\té") for _ in range(rng.randint(0, 60))).encode() for _ in range(200)]
    texts.append(b"long " * 500_000)
    seen = {}
    for t, hashed in zip(texts, word_hashes(texts)):
        words = t.split()
        assert len(words) == len(hashed)
        for w, h in zip(words[:100], hashed):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


# --- vectors -----------------------------------------------------------------

def plain_vectors(rows, cosine=0.93):
    def usable(v, label):
        return (label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
                and any(x != 0 for x in v))
    ok = [k for k, (_, v, lab) in enumerate(rows) if usable(v, lab)]
    links = [(a, b) for a, b in combinations(ok, 2) if rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1])
             and np.dot(rows[a][1], rows[b][1]) / (np.linalg.norm(rows[a][1]) * np.linalg.norm(rows[b][1])) >= cosine]
    root = union(links, range(len(rows)))
    least = {}
    for k, r in root.items():
        least[r] = min(least.get(r, rows[k][0]), rows[k][0])
    count = [0] * len(rows)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return sorted((rows[k][0], count[k], least[root[k]], rows[k][0] == least[root[k]]) for k in range(len(rows)))


@pytest.mark.parametrize("cell", [4096, 12])
def test_vector_dedup_equals_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(vector_dedup, "CELL_ROWS", cell)
    rng = np.random.default_rng(cell)
    f32 = lambda v: [float(x) for x in np.asarray(v, np.float32)]
    rows = []
    for label in (0, 1, 2):
        for _ in range(25):
            c = rng.normal(size=8)
            for _ in range(int(rng.integers(1, 5))):
                rows.append([f32(c + rng.normal(size=8) * 0.18), label])
    rows += [[rows[0][0], 0], [rows[0][0], 0], [rows[0][0], 1], [f32(2 * np.array(rows[0][0])), 0], [rows[0][0], None]]
    rows += [[None, 1], [[0.0] * 8, 1], [[float("nan")] * 8, 1], [[float("inf")] + [0.0] * 7, 1], [[1.0, None], 1], [[], 1], [[1.0, 2.0], 1]]
    ids = rng.permutation(1000)[:len(rows)]
    rows = [(int(i), v, lab) for i, (v, lab) in zip(ids, rows)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("n", F.lit("x"))
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in vector_dedup.dedup_vectors(df).collect())
    assert got == plain_vectors(rows)


def test_large_cells_are_parted_again_and_hold_every_partner(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "CELL_ROWS", 10)
    monkeypatch.setattr(vector_dedup, "MAX_PIVOTS", 4)
    rng = np.random.default_rng(3)
    angle, radius = rng.uniform(0, 2 * np.pi, 400), 0.02
    x = np.stack([np.cos(angle), np.sin(angle)], 1)
    nodes = spark.createDataFrame([(i, 1, "a", 2, v) for i, v in enumerate(x.tolist())],
                                  "__node long, copies long, label string, dim int, vec array<double>")
    rows = vector_dedup.parted(nodes, radius).collect()
    home = {r["__node"]: r["cell"] for r in rows if r["home"]}
    assert len(home) == len(x) == sum(r["home"] for r in rows)
    assert max(c.count(".") for c in home.values()) > 1 and len(rows) < 3 * len(x)
    held = {(r["__node"], r["cell"]) for r in rows}
    near = np.nonzero(np.linalg.norm(x[:, None] - x[None], axis=2) <= radius)
    assert all((int(b), home[int(a)]) in held for a, b in zip(*near))


def test_cells_that_pivots_cannot_prune_stay_whole(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "CELL_ROWS", 10)
    x = np.eye(40).tolist()
    nodes = spark.createDataFrame([(i, 1, "a", 40, v) for i, v in enumerate(x)],
                                  "__node long, copies long, label string, dim int, vec array<double>")
    rows = vector_dedup.parted(nodes, 2.0).collect()
    assert sorted((r["__node"], r["cell"], r["home"]) for r in rows) == [(i, "", True) for i in range(40)]


@pytest.mark.parametrize("cell", [2, 4096])
def test_vector_dedup_of_huge_and_tiny_vectors(spark, monkeypatch, cell):
    monkeypatch.setattr(vector_dedup, "CELL_ROWS", cell)
    vectors = [[1e200, 1e200], [1.1e200, 1e200], [1e-200, 1e-200], [1.0, 0.1], [1e300, 1e299], [5e-324, 0.0],
               [-1e200, 1e-200]]
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vector_dedup.dedup_vectors(df).collect()}
    assert got == {0: (2, 0), 1: (2, 0), 2: (2, 0), 3: (2, 3), 4: (2, 3), 5: (2, 3), 6: (0, 6)}


def test_vector_dedup_of_repeated_rows_and_nothing(spark):
    schema = "vec_id long, embedding array<float>, label int"
    df = spark.createDataFrame([(4, [1.0, 0.0], 1), (4, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (None, [0.0, 1.0], 1)], schema)
    got = sorted((r["vec_id"] or -1, r["n_links"], r["component_id"] or -1) for r in vector_dedup.dedup_vectors(df).collect())
    assert got == [(-1, 0, -1), (2, 2, 2), (4, 2, 2), (4, 2, 2)]
    assert vector_dedup.dedup_vectors(df.limit(0)).collect() == []


def test_cells_hold_every_partner():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(300, 6)), rng.normal(size=(30, 6)) * 0.05 + 1])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    radius = math.sqrt(2 - 2 * 0.93)
    home, member = vector_dedup.cells_of(x, x[:9], radius)
    a, b = np.nonzero(x @ x.T >= 0.93)
    assert member[b, home[a]].all()
    assert member.mean() < 0.9
