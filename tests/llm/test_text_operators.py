"""Token counts, packing, line dedup, language id, URL filters against plain twins."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.llm import language_id, line_dedup, packing, token_count, url_filter

public_tokenizers = pytest.importorskip("public_tokenizers")
DOC = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["", " ", "\n", "a  b   c\n\n d\t▁x ▁▁ y", "日本語 <s> </s> <unk> \x00 é́ İSTANBUL ΣΑΣ ﬁ x y\x1c!!",
       "'s it's I'LL 12 <|endoftext|>x <|startoftext|> don't", "x" * 5000, "word " * 3000, "a\x85b\u2003c d"]


def documents(spark, texts, ids=None):
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in zip(ids, texts)], DOC)


# --- token counts ------------------------------------------------------------

def test_counts_equal_the_library():
    import sentencepiece

    file = public_tokenizers.path("piece_bpe_32k.model")
    sp, merger = sentencepiece.SentencePieceProcessor(model_file=file), token_count.PieceMerger(file)
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice(" abcdeinrst\n.,é▁ß") for _ in range(rng.randint(0, 200))) for _ in range(300)]
    assert [merger.count(t) for t in texts] == [len(sp.encode(t)) for t in texts]


def test_a_small_word_cache_changes_nothing():
    file = public_tokenizers.path("piece_bpe_32k.model")
    big, small = token_count.PieceMerger(file), token_count.PieceMerger(file, keep_words=2)
    assert [big.count(t) for t in ODD] == [small.count(t) for t in ODD]


def test_count_column_handles_nulls_extra_columns_and_empty_tables(spark):
    file = public_tokenizers.path("piece_bpe_32k.model")
    df = spark.createDataFrame([(1, None, 5), (2, "", 6), (2, "hello there", 7)], "doc_id long, text string, n_tokens long")
    rows = {(r[0], r[1]): r["n_tokens"] for r in token_count.count_tokens(df, file).collect()}
    assert rows[(1, None)] == rows[(2, "")] == 0 and rows[(2, "hello there")] > 0
    assert token_count.count_tokens(df.limit(0), file).collect() == []


# --- packing -----------------------------------------------------------------

def test_word_ids_equal_the_library():
    from tokenizers import Tokenizer

    file = public_tokenizers.path("word_bpe_49k.json")
    t, words = Tokenizer.from_file(file), packing.WordIds(file)
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice(" abcdeinrstABC09\n.,'!éÉßΣ\t") for _ in range(rng.randint(0, 200))) for _ in range(300)]
    for text in texts:
        assert words.ids(text) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def one_bin_at_a_time(counts, capacity):
    """Best two fit without repeating bins."""
    left, bins = Counter(counts), []
    while +left:
        content, gap = [], capacity
        while any(n <= gap and c > 0 for n, c in left.items()):
            n = max(n for n, c in left.items() if c > 0 and n <= gap)
            content.append(n)
            left[n] -= 1
            gap -= n
        smallest = min(content)
        if gap and len(content) > 1:
            free = sorted(n for n, c in left.items() if c > 0)
            pairs = [(a + b, max(a, b), a, b) for a in free for b in free
                     if a <= b and smallest < a + b <= gap + smallest and (a != b or left[a] > 1)]
            if pairs:
                best = max(p[0] for p in pairs)
                a, b = next((a, b) for s, _, a, b in sorted(pairs) if s == best)
                content.remove(smallest)
                content += [a, b]
                left[smallest] += 1
                left[a] -= 1
                left[b] -= 1
        bins.append(tuple(sorted(content)))
    return bins


@pytest.mark.parametrize("seed", range(25))
def test_plan_equals_bin_by_bin_packing(seed):
    rng = random.Random(seed)
    counts = Counter(rng.randint(1, 40) for _ in range(rng.randint(1, 300)))
    plan = packing.plan_bins(dict(counts), 40)
    slow = one_bin_at_a_time(counts, 40)
    assert sum(k for k, _ in plan) == len(slow)
    packed = Counter()
    for times, content in plan:
        assert sum(n * k for n, k in content.items()) <= 40
        for n, k in content.items():
            packed[n] += times * k
    assert packed == counts


def test_plan_of_nothing_and_of_bad_lengths():
    assert packing.plan_bins({}) == [] and packing.plan_bins({5: 0}) == []
    with pytest.raises(ValueError):
        packing.plan_bins({3000: 1}, 2048)


def check_packing(rows, texts, capacity):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_bin[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_bin.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        pieces = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(-(-len(ids) // capacity)))
        for r in pieces:
            part = ids[r["start"]:r["start"] + r["length"]]
            assert r["start"] == r["piece"] * capacity and len(part) == r["length"]
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
    return len(by_bin)


def test_packed_documents_round_trip(spark):
    rng = random.Random(3)
    texts = {i: " ".join(rng.choice(["alpha", "beta", "gamma,", "x"]) for _ in range(rng.randint(0, 60))) for i in range(150)}
    texts |= {1000 + i: t for i, t in enumerate(ODD)} | {2000: None} | {3000 + i: "same text" for i in range(60)}
    df = documents(spark, list(texts.values()), list(texts))
    file = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack_documents(df, file, capacity=64).collect()
    n = check_packing(rows, texts, 64)
    assert n <= 1.02 * sum(r["length"] for r in rows) / 64 + 1


def test_packing_of_an_empty_table_and_repeated_rows(spark):
    file = public_tokenizers.path("word_bpe_49k.json")
    assert packing.pack_documents(documents(spark, []), file).collect() == []
    rows = packing.pack_documents(documents(spark, ["a b"] * 5, [7, 7, 7, None, None]), file).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 5


# --- line dedup --------------------------------------------------------------

def plain_line_dedup(rows, min_docs):
    key = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if key(line):
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def test_line_dedup_equals_the_plain_form(spark):
    rng = random.Random(4)
    pool = [" Common LINE\t", "common line", "ÉCLAIR", "éclair", "", "  ", "x", "\x0bY\r", "unique é", "a\x1cb"]
    rows = [(i, "\n".join(rng.choice(pool) + ("" if rng.random() < .7 else str(i)) for _ in range(rng.randint(1, 12))))
            for i in range(60)] + [(100, None), (101, ""), (102, "\n\n"), (103, "\n".join(["common line"] * 400)), (5, "common line")]
    df = documents(spark, [t for _, t in rows], [i for i, _ in rows]).withColumn("kept", F.lit("clash"))
    for least in (2, 10):
        out = line_dedup.dedup_lines(df, min_docs=least)
        got = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["kept"].encode()).hexdigest())
                      for r in out.collect())
        assert got == plain_line_dedup(rows, least)
    assert line_dedup.dedup_lines(df.limit(0)).collect() == []


def test_line_dedup_runs_no_python(spark):
    plan = line_dedup.dedup_lines(documents(spark, ["a"]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- language id -------------------------------------------------------------

def test_language_id_on_held_out_text(spark):
    rng = random.Random(5)
    words = {"xa": ["the", "and", "thing", "with", "over"], "xb": ["der", "und", "schön", "für", "nicht"],
             "xc": ["les", "être", "où", "avec", "nous"]}
    rows = [(i, " ".join(rng.choice(words[lab]) for _ in range(rng.randint(8, 120))), lab)
            for i, lab in enumerate(rng.choice(sorted(words)) for _ in range(400))]
    odd = [(1000, None, "xa"), (1001, "", "xb"), (1002, "12 34 !!", "xc"), (1003, "the and " * 5000, None), (None, "der und", "xb")]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    model = language_id.fit(df.filter(language_id.training_rows()))
    got = language_id.identify(df, model).collect()
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 1000
            and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert held and sum(r["lang_pred"] == r["lang"] for r in held) >= 0.98 * len(held)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and by[1000]["score"] == 0
    assert by[1003]["lang_pred"] == "xa" and all(0 <= r["score"] <= 1 for r in got)
    assert language_id.identify(df.limit(0), model).collect() == []


def test_language_id_without_labels_knows_nothing(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert language_id.fit(df) is None
    assert language_id.identify(df, None).first()["lang_pred"] == "und"


def test_draw_is_bounded_and_takes_equal_rows_once(spark, monkeypatch):
    """One id on many texts, one row many times, and a large label: at most ``per_label`` each."""
    rows = [(1, f"text number {i}", "xa") for i in range(400)] + [(2, "one and the same", "xb")] * 300
    rows += [(i, f"words of {i}", "xc") for i in range(10, 400)] + [(None, "no id", "xb"), (None, "no id", "xb")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawn = []
    monkeypatch.setattr(language_id, "train", lambda samples: drawn.append(samples))
    for _ in range(2):
        language_id.fit(df, per_label=50, windows_per_doc=1)
    assert drawn[0] == drawn[1]
    of = Counter(lab for lab, _ in drawn[0])
    assert 20 < of["xa"] <= 50 and 20 < of["xc"] <= 50 and of["xb"] <= 2


def test_forward_pass_equals_a_plain_convolution():
    rng = np.random.default_rng(4)
    f = language_id.FILTERS
    widths = language_id.WIDTHS
    model = language_id.ByteCNN(["xa", "xb", "xc"], [rng.normal(size=(w, 256, f)) for w in widths],
                                rng.normal(size=len(widths) * f), rng.normal(size=(len(widths) * f, 3)), rng.normal(size=3))
    texts = ["a".encode(), "schön und gut ".encode() * 40, bytes(range(1, 256))]
    got = model.predict(texts, model.pairs())
    for row, text in zip(got, texts):
        votes = np.zeros(3)
        for at in range(0, len(text), language_id.WINDOW):
            part = text[at:at + language_id.WINDOW]
            window = part.ljust(language_id.WINDOW, b"\0")
            pooled = [max(sum(t[k][window[i + k]][j] for k in range(w)) for i in range(len(window) - w + 1))
                      for w, t in zip(widths, model.tables) for j in range(f)]
            z = np.maximum(np.array(pooled) + model.bias, 0) @ model.dense + model.offset
            votes += len(part) * np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert np.allclose(row, votes / len(text), atol=1e-5)


def test_windows_cover_whole_texts():
    texts = [b"a" * 1000, b"", b"bc" * 128, b"d"]
    windows, owner, weight = language_id.cut_windows(texts)
    assert Counter(owner.tolist()) == {0: 4, 2: 1, 3: 1}
    assert weight.tolist() == [256, 256, 256, 232, 256, 1]
    assert b"".join(w.tobytes() for w in windows[:4])[:1000] == texts[0]


# --- URL filters -------------------------------------------------------------

RULES = [url_filter.domain_rule(v, t) for v, t in
         [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
          ("block", "com/de/"), ("block", "a*b.net/x?y")]] + [url_filter.Rule("block", "glob-rule-text", "ads?.*", "/b*r/*.gif")]


def plain_rule(url):
    host, path = url_filter.canonical(url)
    best = None
    for r in RULES[:6]:
        h, _, p = r.name.partition("/")
        if ("." + host).endswith("." + h) and path.startswith("/" + p) and (best is None or len(r.name) > len(best.name)):
            best = r
    return host, path, best


def test_url_rules_equal_the_plain_form(spark):
    rng = random.Random(6)
    hosts = ["example.org", "EXAMPLE.org", "a.example.org", "badexample.org", "org", "x.com", "com", "", "a*b.net", "axb.net", "é.com", "h.com:80"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12?x", "/fr/a", "/de/#z", "/x?y", "/x.org/", "//", "/" + "z" * 3000]
    urls = [rng.choice(["http://", "https://", "", "a://b://"]) + rng.choice(hosts) + rng.choice(paths) for _ in range(500)]
    urls += [None, "", "://", "no scheme.org/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit(1))
    for r in url_filter.judge_urls(df, RULES[:6]).collect():
        host, path, rule = plain_rule(r["url"])
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (rule.name if rule else None), r["url"]
        assert r["verdict"] == (rule.verdict if rule else "allow")
    assert url_filter.judge_urls(df.limit(0), RULES).collect() == []


def test_globs_and_many_words():
    filler = [url_filter.domain_rule("block", f"site{i}.example/path{i}") for i in range(60)]
    a = url_filter.ShiftAnd(filler + RULES)
    assert a.words > 10
    hosts = ["site7.example", "www.site59.example", "site7.example", "ads1.net", "ads.net", "ads1.net"]
    paths = ["/path7x", "/path59", "/path8", "/bar/x.gif", "/bar/x.gif", "/banner/y.gif"]
    names = [(filler + RULES)[i].name if i >= 0 else None for i in a.best(["site7.example", "www.site59.example", "site7.example"], paths[:3])]
    assert names == ["site7.example/path7", "site59.example/path59", None]
    glob = url_filter.ShiftAnd([url_filter.Rule("block", "g", "*.ads?.*", "/b*r/*.gif")])
    assert (glob.best(hosts[3:], paths[3:]) >= 0).tolist() == [True, False, True]


def test_many_rules_take_bounded_memory(monkeypatch):
    """20,000 rules: a slice of URLs at a time, with the answers of one rule after the other."""
    rules = [url_filter.domain_rule("block", f"site{i}.example/path{i % 7}") for i in range(20_000)] + RULES[:5]
    urls = [f"http://a.site{i * 37}.example/path{i * 37 % 7}/x" for i in range(300)] + ["http://w.org/x", None, ""]
    automaton = url_filter.ShiftAnd(rules)
    hosts, paths = zip(*map(url_filter.canonical, urls))
    sizes = []
    run = url_filter.ShiftAnd.run
    monkeypatch.setattr(url_filter.ShiftAnd, "run", lambda self, h, p: sizes.append(len(h) * 8 * self.words) or run(self, h, p))
    best = automaton.best_in_slices(list(hosts), list(paths))
    assert max(sizes) <= url_filter.STATE_BYTES and len(sizes) > 1
    want = [i * 37 if i * 37 < 20_000 else -1 for i in range(300)] + [20_000, -1, -1]
    assert best.tolist() == want
    assert automaton.best_in_slices([], []).tolist() == []
