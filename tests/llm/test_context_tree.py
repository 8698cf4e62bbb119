"""Context-tree weighting against trees written as plain recursion."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.llm import context_tree as ct

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def spelled(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", text) if w]


def plain_scores(texts, trained, depth):
    """log10 probability of each text: one tree per decision, Pw by recursion over contexts."""
    counts = defaultdict(lambda: [0, 0])            # (context nearest first, bits so far) -> zeros, ones
    contexts = defaultdict(set)

    def steps(text):
        data = bytes([ct.START]) * depth + " ".join(spelled(text)).encode() + bytes([ct.END])
        for i in range(depth, len(data)):
            yield tuple(data[i - j] for j in range(1, depth + 1)), format(data[i], "08b")

    for text, mine in zip(texts, trained):
        if mine:
            for context, bits in steps(text):
                for k in range(8):
                    for d in range(depth + 1):
                        counts[context[:d], bits[:k]][int(bits[k])] += 1
                        if d:
                            contexts[context[:d - 1], bits[:k]].add(context[:d])

    def log_kt(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)

    known = {}

    def log_pw(context, prefix):
        if (context, prefix) not in known:
            pe = log_kt(*counts[context, prefix]) if (context, prefix) in counts else 0.0
            if len(context) < depth:
                below = sum(log_pw(c, prefix) for c in contexts.get((context, prefix), ()))
                high = max(pe, below)
                known[context, prefix] = math.log(.5) + high + math.log(math.exp(pe - high) + math.exp(below - high))
            else:
                known[context, prefix] = pe
        return known[context, prefix]

    def predicted(context, prefix, bit, d=0):
        a, b = counts[context[:d], prefix] if (context[:d], prefix) in counts else (0, 0)
        here = ((b if bit else a) + .5) / (a + b + 1)
        if d == depth:
            return here
        weight = math.exp(math.log(.5) + log_kt(a, b) - log_pw(context[:d], prefix))
        return weight * here + (1 - weight) * predicted(context, prefix, bit, d + 1)

    return [sum(math.log10(predicted(c, bits[:k], int(bits[k]))) for c, bits in steps(t) for k in range(8))
            for t in texts]


def plain_base(texts, trained):
    counts = Counter()
    for text, mine in zip(texts, trained):
        if mine:
            counts.update([*spelled(text), None])
    n, v = sum(counts.values()), len(counts)
    return [(len(spelled(t)) + 1, sum(counts[w] > 0 for w in [*spelled(t), None]), n,
             sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*spelled(t), None])) for t in texts]


TEXTS = ["The cat sat on the mat. the cat", "THE dog\tsat\non the  log", "", None, " \x0b\r\n", "a", "ÄÖ ü日本語 ß İ",
         "abab" * 30, "the cat sat on the mat. the cat", "\x1c\x85 odd space \x00 nul", "zzz unseen words"]


def scores(spark, texts, trained, parts=3, **kw):
    df = spark.createDataFrame([(i, t, "x", "s", 1) for i, t in enumerate(texts)], SCHEMA).repartition(parts)
    some = F.col("doc_id").isin([i for i, m in enumerate(trained) if m] or [-1])
    return {r["doc_id"]: r for r in ct.score_documents(df, some, **kw).collect()}


def check(found, texts, trained, depth):
    assert sorted(found) == list(range(len(texts)))
    for i, (score, base) in enumerate(zip(plain_scores(texts, trained, depth), plain_base(texts, trained))):
        r = found[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == base[:3]
        assert r["base_score"] == pytest.approx(base[3], abs=1e-9)
        assert r["score"] == pytest.approx(score, rel=1e-6, abs=1e-6)
        assert r["bits_per_byte"] == pytest.approx(-score * math.log2(10) / r["n_bytes"], rel=1e-6, abs=1e-9)


@pytest.mark.parametrize("depth", [2, 5])
def test_equals_plain_trees(spark, depth):
    trained = [i % 3 != 2 for i in range(len(TEXTS))]
    check(scores(spark, TEXTS, trained, depth=depth), TEXTS, trained, depth)


def test_small_chunks_slices_and_windows_change_nothing(spark, monkeypatch):
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choice(["ab", "abc", "Bca", "cab", "é"]) for _ in range(rng.randint(0, 60)))
                     for _ in range(20)]
    trained = [i % 4 != 1 for i in range(len(texts))]
    for name, size in (("CHUNK_BYTES", 100), ("WINDOW_BYTES", 16), ("SLICE_GRAMS", 5)):
        monkeypatch.setattr(ct, name, size)
    check(scores(spark, texts, trained, depth=4, buckets=3), texts, trained, 4)


def test_without_training_rows(spark):
    found = scores(spark, ["ab c", None], [False, False], depth=3)
    assert found[0]["score"] == pytest.approx(-8 * 5 * math.log10(2)) and found[0]["bits_per_byte"] == pytest.approx(8)
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in (found[0], found[1])] == [
        (3, 0, 0, 0.0), (1, 0, 0, 0.0)]


def test_odd_rows(spark):
    schema = "doc_id long, text string, score string, trained int, kind string"
    rows = [(None, "one two", "x", 1, "y"), (3, "one two", None, 2, None), (3, "one two", None, 2, None), (4, None, "", 0, "")]
    df = spark.createDataFrame(rows, schema)
    out = ct.score_documents(df, F.col("doc_id") < 4, depth=2).collect()
    assert len(out) == 4 and {r["trained"] for r in out if r["doc_id"] is None} == {False}
    assert len({round(r["score"], 9) for r in out if r["n_tokens"] == 3}) == 1
    assert {r["train_tokens"] for r in out} == {6}
    assert ct.score_documents(df.limit(0), F.lit(True)).collect() == []


def test_arithmetic():
    x = np.concatenate([np.arange(1, 400) / 2, [1e3 + .5, 1e6, 1e9 + .5]])
    np.testing.assert_allclose(ct.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-13, atol=1e-13)
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64))
    assert (ct.unpacked(ct.packed(keys)) == keys).all()
    counts = np.array([0, 1, 255, 256, 1 << 40])
    assert (ct.from_planes(ct.planes(counts)) == counts).all()


def test_probabilities_of_the_next_byte_sum_to_one():
    """All 256 bytes after a context, seen or not."""
    rng = np.random.default_rng(2)
    depth, context = 3, np.uint64(0x616263)
    tally = ct.Tally()
    ct.tally_texts(tally, [bytes(rng.integers(97, 100, 500).tolist())], True, depth)
    tally.add((context << np.uint64(8)) + np.arange(256, dtype=np.uint64), np.zeros(256, np.int64))
    keys, counts = tally.total()
    nodes: dict = {}
    for part in ct.subtree_slices(keys, depth):
        for node, *row in zip(*ct.Forest(keys[part], counts[part], depth).above()):
            nodes[node] = [a + b for a, b in zip(nodes.get(node, (0, 0, 0.0)), row)]
    top = ct.Top(np.array(list(nodes)), *(np.array(c) for c in zip(*nodes.values())))
    p = np.concatenate([10 ** ct.Forest(keys[s], counts[s], depth).log_probability(top)
                        for s in ct.subtree_slices(keys, depth)])
    assert p[keys >> np.uint64(8) == context].sum() == pytest.approx(1.0)
