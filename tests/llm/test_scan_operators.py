"""Decontamination, license scans, HTML extraction and the pipeline."""

from __future__ import annotations

import hashlib
import random
import re
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.llm import decontaminate, html_extract, license_scan
from flowlake.llm.common import PUNCTUATION_BYTES, word_hashes

SF_DIR = "/root/testdata/sf0.001"


# --- decontamination ---------------------------------------------------------

def plain_distance(p, t):
    before = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        row = [i]
        for j, d in enumerate(t, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (c != d)))
        before = row
    return min(before)


def test_substring_distance_equals_the_table():
    rng = random.Random(1)
    word = lambda n: bytes(rng.choice(b"abc ") for _ in range(rng.randint(0, n)))
    for _ in range(400):
        p, t = word(14), word(25)
        assert decontaminate.substring_distance(p, t) == plain_distance(p, t)


def prose(rng, n):
    return [rng.choice(["the", "of", "and"]) if rng.random() < .3 else "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
            for _ in range(n)]


def found(items, text):
    hashed = word_hashes([text.lower().encode()], PUNCTUATION_BYTES)
    return items.matches(text, items.proposals(hashed)[0], decontaminate.MAX_RATIO)


def test_recall_of_exact_and_edited_items():
    rng = random.Random(2)
    bench = [(i, " ".join(prose(rng, rng.randint(12, 60)))) for i in range(300)]
    items = decontaminate.Items.build(bench)
    exact = edited = due = 0
    for i, text in bench:
        around = lambda: " ".join(prose(rng, rng.randint(0, 80)))
        exact += any(m[0] == i and m[2] == 0 for m in found(items, f"{around()} {text.upper()}, {around()}"))
        words = [w for w in text.split() if rng.random() > .03]
        words = [rng.choice(prose(rng, 5)) if rng.random() < .05 else w for w in words]
        page = f"{around()} {' '.join(words)} {around()}"
        p, t = (b" ".join(decontaminate.normalised(x)) for x in (text, page))
        if decontaminate.substring_distance(p, t) <= int(decontaminate.MAX_RATIO * len(p)):
            due += 1
            edited += any(m[0] == i for m in found(items, page))
    assert exact >= 0.99 * len(bench)
    assert due > 200 and edited >= 0.95 * due


def damaged(rng, words):
    """Words changed, dropped and added as far as MAX_RATIO lets."""
    size = int(decontaminate.MAX_RATIO * len(" ".join(words)))
    now = words
    while True:
        nxt, i, x = list(now), rng.randrange(len(now)), rng.random()
        nxt[i:i + 1] = prose(rng, 1) if x < .5 else [] if x < .75 else [*prose(rng, 1), now[i]]
        if decontaminate.substring_distance(" ".join(words).encode(), " ".join(nxt).encode()) > size:
            return now
        now = nxt


@pytest.mark.parametrize("low, high", [(12, 14), (20, 30), (45, 60)])
def test_recall_at_the_ratio(low, high):
    rng = random.Random(low)
    bench = [(i, " ".join(prose(rng, rng.randint(low, high)))) for i in range(60)]
    items = decontaminate.Items.build(bench)
    hits = sum(any(m[0] == i for m in found(items, " ".join(prose(rng, 7) + damaged(rng, t.split()) + prose(rng, 7))))
               for i, t in bench)
    assert hits >= decontaminate.TARGET_RECALL * len(bench)


def test_short_and_unspaced_items_are_found_without_loss():
    rng = random.Random(8)
    han = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))
    bench = [(i, " ".join(prose(rng, rng.randint(4, 11)))) for i in range(25)]
    bench = [(i, t) for i, t in bench if len(t) >= decontaminate.MIN_BYTES]
    bench += [(100, han(30)), (101, han(4)), (102, "\u3002".join(han(12) for _ in range(14)))]
    items = decontaminate.Items.build(bench)
    pages = [f"{' '.join(prose(rng, 9))} {t} {' '.join(prose(rng, 9))}" for _, t in bench]
    pages += [" ".join(prose(rng, 9) + damaged(rng, t.split()) + prose(rng, 9)) for i, t in bench if i < 100]
    pages += ["x" + t[:1] + han(1) + t[2:] + "y" for i, t in bench if i in (100, 102)]
    for page in pages:
        spelled = b" ".join(decontaminate.normalised(page))
        want = {i: plain_distance(p, spelled) for (i, _), p in zip(bench, items.texts)}
        got = {m[0]: m[2] for m in found(items, page)}
        assert got == {i: d for i, d in want.items() if d <= decontaminate.MAX_RATIO * len(items.texts[items.ids.index(i)])}


def test_walks_do_not_read_past_an_item():
    rng = random.Random(9)
    for n in (12, 13, 20, 40):
        bench = [(i, " ".join(prose(rng, n))) for i in range(40)]
        items = decontaminate.Items.build(bench)
        assert all(any(m[0] == i and not m[2] for m in found(items, t)) for i, t in bench)
        assert all((items.offset < n).tolist()) and set(items.owner.tolist()) == set(range(40))


def test_clean_and_odd_documents(spark):
    rng = random.Random(3)
    bench = [(i, " ".join(prose(rng, 30))) for i in range(50)] + [(100, None), (101, ""), (102, "too short")]
    docs = [(i, " ".join(prose(rng, 200))) for i in range(100)]
    docs += [(200, None), (201, ""), (202, "too short"), (203, "of " * 20_000), (204, "x\n" + bench[7][1].replace(" ", ",\n").title()),
             (204, bench[3][1] + " " + bench[4][1]), (None, bench[5][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("leaks", F.lit("clash"))
    b = spark.createDataFrame(bench, "item_id long, text string")
    got = sorted((r["doc_id"] or -1, r["item_id"]) for r in decontaminate.contaminated(d, b).collect())
    assert got == [(-1, 5), (204, 3), (204, 4), (204, 7)]
    assert decontaminate.contaminated(d.limit(0), b).collect() == []
    assert decontaminate.contaminated(d, b.limit(0)).collect() == []


def test_item_blocks_cover_all_items(spark):
    rng = random.Random(4)
    bench = [(i, " ".join(prose(rng, 20))) for i in range(60)]
    b = spark.createDataFrame(bench, "item_id long, text string")
    blocks = list(decontaminate.item_blocks(b, block=20))
    assert len(blocks) > 1 and sorted(i for x in blocks for i in x.ids) == list(range(60))


# --- licenses ----------------------------------------------------------------

def test_patience_alignment():
    rng = random.Random(5)
    for _ in range(200):
        a = [rng.choice("abcdefghij") for _ in range(rng.randint(0, 25))]
        b = [rng.choice("abcdefghij") for _ in range(rng.randint(0, 25))]
        pairs = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert len(license_scan.align(list("abcdef"), list("abcdef"))) == 6
    assert license_scan.align(list("xaybz"), list("ab")) == [(1, 0), (3, 1)]
    assert license_scan.rising([(0, 5), (1, 1), (2, 2), (3, 9), (4, 3)]) == [(1, 1), (2, 2), (4, 3)]


def test_every_template_is_found_in_long_text(spark):
    rng = random.Random(6)
    rows = []
    for k, (name, text) in enumerate(license_scan.TEMPLATES):
        words = text.split()
        if len(words) > 15:
            words[4] = "altered"
        rows.append((k, name, " ".join(prose(rng, 400)) + "\n * " + "\n * ".join(words) + " " + " ".join(prose(rng, 400))))
    rows += [(100, "", None), (101, "", ""), (102, "", " ".join(prose(rng, 3000))), (103, "", "released the license under mit"),
             (104, "MIT", "Released under the MIT License. " * 500), (104, "MIT", "released under the MIT license")]
    df = spark.createDataFrame(rows, "doc_id long, want string, text string").withColumn("licenses", F.lit(0))
    for r in license_scan.with_licenses(df).collect():
        assert [x["license"] for x in r["licenses"]] == ([r["want"]] if r["want"] else []), r["doc_id"]
    assert license_scan.with_licenses(df.limit(0)).collect() == []


def scanned(text, pairs=license_scan.TEMPLATES):
    known = license_scan.templates(pairs)
    vocabulary = np.unique(np.concatenate([t.hashes for t in known]))
    hashed = word_hashes([text.lower().encode()], PUNCTUATION_BYTES)[0]
    return license_scan.scan(text, hashed, known, vocabulary, license_scan.MIN_COVERAGE)


def test_notice_whose_rarest_word_stands_elsewhere():
    text = "Licensed under the MIT License. Last week the film was released. Licensed under the MIT License."
    assert [x[0] for x in scanned(text)] == ["MIT"]
    rng = random.Random(10)
    name, grant = max(license_scan.TEMPLATES, key=lambda x: len(x[1]))
    words = grant.split()
    for gone in range(0, len(words), 5):
        cut = words[:gone] + words[gone + 1:]
        page = prose(rng, 300) + [words[gone]] + prose(rng, 300) + cut + prose(rng, 300)
        assert name in [x[0] for x in scanned(" ".join(page))]


@pytest.mark.parametrize("want, text", [
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.")])
def test_neighbours_compete(want, text):
    assert [x[0] for x in scanned(f"some words before. {text} And some after.")] == [want]


@pytest.mark.parametrize("want, text", [
    (["Apache"], "This software is released under the Apache license."),
    ([], "This software is released under the license."),
    (["BSD"], "Released under the BSD license"),
    (["CC-BY-4.0"], "Licensed under CC BY 4.0."),
    (["CC-BY-3.0"], "Licensed under CC BY 3.0."),
    (["Apache"], "Licensed under the Apache License, Version 1.0."),
    (["Apache-2.0"], "Licensed under the Apache License, Version 2.0."),
    ([], "This work is licensed under the GNU General Public License, version 1."),
    (["CC-BY-ND-4.0"], "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    (["CC-BY-NC-SA-4.0"], "Licensed under CC BY-NC-SA 4.0."),
    (["AGPL-3.0"], "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "Affero General Public License as published by the Free Software Foundation, either version 3 of the License."),
    (["MIT", "Apache-2.0"], "Licensed under the MIT License. Parts are licensed under the Apache License, Version 2.0.")])
def test_deciding_words(want, text):
    assert [x[0] for x in scanned(f"some words before. {text} And some after.")] == want


def test_every_notice_counts():
    page = " and then ".join(["Released under the MIT License."] * 7 + ["Licensed under CC BY 4.0."] * 3)
    assert [(x[0], x[4]) for x in scanned(page)] == [("MIT", 7), ("CC-BY-4.0", 3)]


def test_scan_equals_a_plain_search():
    """Every window from every word of a template, without the counting filters."""
    rng = random.Random(12)
    known = license_scan.templates()
    for trial in range(60):
        words = []
        for _ in range(rng.randint(1, 6)):
            notice = license_scan.spelled(rng.choice(license_scan.TEMPLATES)[1])
            words += [w for w in notice if rng.random() > 0.07] + [w.encode() for w in prose(rng, rng.randint(0, 8))]
        text = b" ".join(words).decode()
        found = set()
        for t in known:
            width = len(t.words) + 2 * max(3, len(t.words) // 4)
            for start in [i for i, w in enumerate(words) if w in t.words]:
                found.add(license_scan.fitted(words, start, start + width, t, license_scan.MIN_COVERAGE))
        kept = []
        for notice in sorted(found - {None}):
            if all(notice[2] - notice[1] <= n[2] or n[2] - n[1] <= notice[2] for n in kept):
                kept.append(notice)
        want = {n[3] for n in kept}
        got = scanned(text)
        assert {x[0] for x in got} == want and sum(x[4] for x in got) == len(kept), trial


# --- HTML --------------------------------------------------------------------

def test_blocks_of_untidy_markup():
    page = ("<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var t='</p>';</script></head><body>"
            "<nav><ul><li><a href='/x'>One</a><li>two</ul></nav><div class=\"ad top\">Ad</div><!-- <p>no</p> -->"
            "<article><h1>H</h1><p><b>X<br>y &nbsp;z<p title='a>b'>Q &lt;3 a < b</article><footer>f")
    blocks = html_extract.read_blocks(page)
    assert [b.text for b in blocks] == ["T & x", "One", "two", "Ad", "H", "X y z", "Q <3 a < b", "f"]
    assert html_extract.markup_labels(blocks).tolist() == [0, 0, 0, 0, 1, 1, 1, 0]
    for odd in (None, "", "<", "<p", "<!--", "<script>x", "plain", "</p></div>", "<a b='c" * 50):
        html_extract.read_blocks(odd)
    assert [b.text for b in html_extract.read_blocks("plain")] == ["plain"]


@pytest.mark.parametrize("tag, kept", [
    ("<svg-icon name=x></svg-icon>", ["a", "b", "c"]), ("<template-x>", ["a", "b", "c"]), ("<svg class='i' />", ["a", "b", "c"]),
    ("<svg/>", ["a", "b", "c"]), ("<svg a='/>'><text>no</text></svg >", ["a", "b", "c"]), ("<noscript>", ["a", "b", "c"]),
    ("<iframe src=x>", ["a", "b", "c"]), ("<object>", ["a", "b", "c"]), ("<canvas>", ["a", "b", "c"]), ("<svg>", ["a", "b", "c"]),
    ("<template>", ["a", "b", "c"]), ("<noscript>no</noscript>", ["a", "b", "c"]), ("<script>", ["a"]), ("<style x>", ["a"])])
def test_raw_elements_swallow_their_own_text_only(tag, kept):
    blocks = html_extract.read_blocks(f"<article><p>a</p>{tag}<p>b</p><p>c</p></article>")
    assert [b.text for b in blocks] == kept


def test_vectors_read_whole_blocks():
    head = " ".join(["word"] * 100)
    x = html_extract.vectors([html_extract.Block(f"{head} {tail}", ()) for tail in ("one two", "three four")], {})
    n = html_extract.PATH_SIZE + html_extract.WORD_SIZE
    assert x[0, n + 2] == x[1, n + 2] == np.float32(102 / 40)
    assert (x[0, html_extract.PATH_SIZE:n] != x[1, html_extract.PATH_SIZE:n]).any()


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    net = html_extract.BiLSTM.fresh(1)
    net.w = [w.astype(np.float64) for w in net.w]
    net.b = [b.astype(np.float64) for b in net.b]
    net.out, net.bias = net.out.astype(np.float64), net.bias.astype(np.float64)
    x, mask = html_extract.padded([rng.normal(size=(n, html_extract.INPUT)) for n in (4, 2, 3)])
    x = x.astype(np.float64)
    y = rng.integers(0, 2, mask.shape).astype(float)

    def loss():
        z = net.logits(x, mask)
        return float(((np.logaddexp(0, z) - y * z) * mask).sum() / mask.sum())
    for p, g in zip(net.params(), net.gradients(x, mask, y)):
        for at in [tuple(rng.integers(0, s) for s in p.shape) for _ in range(4)]:
            old, step = p[at], 1e-3
            p[at] = old + step
            up = loss()
            p[at] = old - step
            down = loss()
            p[at] = old
            assert abs((up - down) / (2 * step) - g[at]) < 2e-4


def test_trained_labeller_on_unseen_frames(spark):
    rng = random.Random(7)
    texts = [" ".join(prose(rng, rng.randint(3, 60))).capitalize() + "." for _ in range(400)]
    pages = html_extract.generated_pages(texts, 120, seed=1)
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    net = html_extract.fit(df, generated=300)
    held = html_extract.generated_pages(texts, 100, seed=2)
    odd = [(1000, None), (1001, ""), (1002, "<p>"), (1003, "<html><body><nav>" + "<p>x</p>" * 3000 + "</nav></body></html>")]
    df = spark.createDataFrame(list(enumerate(held)) + odd, "page_id long, html string").withColumn("text", F.lit("clash"))
    right = 0
    out = {r["page_id"]: r["text"] for r in html_extract.extract(df, net).collect()}
    for k, page in enumerate(held):
        blocks = html_extract.read_blocks(page)
        want = "\n".join(b.text for b, y in zip(blocks, html_extract.markup_labels(blocks)) if y)
        right += out[k] == want
    assert right >= 90
    assert [out[i] for i in (1000, 1001, 1002)] == [""] * 3
    assert html_extract.extract(df.limit(0), net).collect() == []


def test_frames_of_unknown_names_keep_their_text():
    rng = random.Random(17)
    texts = [" ".join(prose(rng, rng.randint(8, 60))).capitalize() + "." for _ in range(400)]
    learned = html_extract.generated_pages(texts, 1000)
    read = [html_extract.read_blocks(h) for h in learned]
    read += [html_extract.read_blocks(h, html_extract.unnamed(k)) for k, h in enumerate(learned)]
    known: dict = {}
    net = html_extract.train([(html_extract.vectors(b, known), html_extract.markup_labels(b)) for b in read])
    right = links = 0
    for k in range(100):
        some = [" ".join(prose(rng, rng.randint(15, 60))).capitalize() + "." for _ in range(4)]
        menu = "".join(f"<li><a href='/{i}'>{w}</a></li>" for i, w in enumerate(prose(rng, 6)))
        box, name = ("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(2))
        page = (f"<html><body><div class='{box}'><ul>{menu}</ul></div><div class='{name}'><p>" + "</p><p>".join(some)
                + "</p></div></body></html>")
        got = html_extract.main_text([html_extract.read_blocks(page)], net, known)[0].split("\n")
        right += all(t in got for t in some)
        links += any(w in got for w in re.findall(r"'>([^<]*)</a>", menu))
    assert right >= 80 and links <= 10, (right, links)


def test_reading_is_linear_in_nesting_and_unclosed_elements():
    for page in ("<div class='x'>a " * 30_000, "<svg >" * 30_000 + "a", "<b>" * 30_000 + "</i>" * 30_000 + "a",
                 "<i><div>" * 15_000 + "x</i>" * 15_000):
        began = time.perf_counter()
        assert html_extract.read_blocks(page)
        assert time.perf_counter() - began < 5


# --- queries and pipeline ----------------------------------------------------

@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not present")
def test_main_text_of_the_given_pages(spark):
    import html

    from flowlake.llm.queries import QUERIES

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for r in QUERIES["op3_html_extraction"](spark, SF_DIR).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(x for x in parts if x) and r["n_chars"] == len(r["text"])


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables not present")
def test_pipeline_equals_its_plain_twin(spark):
    import corpus_pipeline as pipeline
    from test_pair_operators import plain_join
    from test_text_operators import check_packing, plain_line_dedup

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    start = docs
    for name, stage in pipeline.STAGES[:4]:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == start.columns
        after = {r["doc_id"]: r for r in docs.collect()}
        if name == "language_id":
            assert len(after) >= 0.99 * len(before)
            assert all(after[i] == before[i] for i in after)
        elif name == "line_dedup":
            plain = plain_line_dedup([(i, r["text"]) for i, r in before.items()], 10)
            digest = {(i, hashlib.sha256(r["text"].encode()).hexdigest()) for i, r in after.items()}
            assert digest == {(i, sha) for i, _, _, sha in plain} and any(x[2] for x in plain)
            assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        elif name == "ngram_jaccard_join":
            roots = plain_join([(i, r["text"]) for i, r in before.items()])
            assert set(after) == {i for i, (_, root) in roots.items() if root == i} and len(after) < len(before)
        else:
            bench = [" ".join(re.findall(r"[^\W_]+", r["text"].lower()))
                     for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            leaky = {i for i, r in before.items()
                     if any(b in " ".join(re.findall(r"[^\W_]+", r["text"].lower())) for b in bench)}
            assert not leaky & set(after) and len(before) - len(after) <= len(leaky) + 1
        docs = spark.createDataFrame(list(after.values()), start.schema)
    rows = pipeline.STAGES[4][1](spark, docs, SF_DIR).collect()
    assert check_packing(rows, {i: r["text"] for i, r in after.items()}, 2048) <= sum(r["length"] for r in rows) / 2048 * 1.02 + 1



def test_near_duplicate_stage_tells_rows_apart_whatever_their_ids(spark):
    import corpus_pipeline as pipeline

    t, near = "one two three four five six seven eight nine ten " * 3, "another text that nothing else is like at all"
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, t), (5, t), (5, near), (None, t), (None, t), (1, t), (None, None), (None, None), (5, "")]
    docs = spark.createDataFrame([(i, x, "en", "s", len(x or "")) for i, x in rows], schema)
    kept = pipeline.keep_one_of_each_group(spark, docs, "")
    assert kept.columns == docs.columns
    # one row of the group, under its first id; texts without words are linked with nothing
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(1, t), (5, near), (None, None), (None, None), (5, "")], key=str)
    unnamed = pipeline.keep_one_of_each_group(spark, docs.filter("doc_id is null and text is not null"), "")
    assert [(r["doc_id"], r["text"]) for r in unnamed.collect()] == [(None, t)]
    assert pipeline.keep_one_of_each_group(spark, docs.limit(0), "").collect() == []
