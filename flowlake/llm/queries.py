"""The dealt operators as named queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm import (context_tree, conversation_repair, decontaminate, html_extract, language_id, license_scan, line_dedup, ngram_join,
                          packing, token_count, url_filter, vector_dedup, whitening)
from flowlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return wrap


@query("op1_best_fit_packing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


VECTOR_SQL = r"""
WITH RECURSIVE e AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ok AS (
  SELECT vec_id, label, v, sqrt(list_dot_product(v, v)) AS norm FROM e
  WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
  ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.93),
reach(a, b) AS (SELECT vec_id, vec_id FROM e UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT r.a AS vec_id, CAST(coalesce(any_value(c.n), 0) AS BIGINT) AS n_links, min(r.b) AS component_id,
       r.a = min(r.b) AS kept
FROM reach r LEFT JOIN counted c ON c.a = r.a GROUP BY r.a
"""


@query("op2_embedding_near_dedup", VECTOR_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.dedup_vectors(table(spark, sf_dir, "embeddings"))


@query("op3_html_extraction")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = html_extract.extract(pages, html_extract.fit(pages))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


LINE_DEDUP_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos FROM docs),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, c.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, CAST(count_if(dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op4_line_dedup", LINE_DEDUP_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op5_license_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (document, license found)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (license_scan.with_licenses(docs).select("doc_id", F.explode("licenses").alias("l"))
            .select("doc_id", "l.*"))


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    train = language_id.training_rows("doc_id")
    model = language_id.fit(docs.filter(train))
    return (language_id.identify(docs.select("doc_id", "text"), model)
            .select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2,
                                         F.lit(False)).alias("held_out"), "lang_pred", "score"))


@query("op7_benchmark_decontamination")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (document, benchmark item found in it)."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


NGRAM_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)] END) AS sh FROM w),
n AS (SELECT doc_id, len(sh) AS n FROM s),
e AS (SELECT doc_id, unnest(sh) AS x FROM s),
many AS (SELECT x FROM e GROUP BY x HAVING count(*) > 1),
f AS (SELECT e.* FROM e SEMI JOIN many ON e.x = many.x),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM f a JOIN f b ON a.x = b.x AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM n UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM n JOIN reach r ON r.a = n.doc_id GROUP BY ALL
"""


@query("op8_ngram_jaccard_join", NGRAM_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_count.count_tokens(docs, tokenizer_file("piece_bpe_32k.model"))
    return counted.select("doc_id", F.coalesce(F.octet_length("text").cast("long"), F.lit(0)).alias("n_bytes"),
                          "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


#: The contract's rules, in its order.
URL_RULES = [url_filter.domain_rule("allow", "org/"), url_filter.domain_rule("block", "example.org/es/"),
             url_filter.domain_rule("block", "example.org/en/1"), url_filter.domain_rule("allow", "com/fr/"),
             url_filter.domain_rule("block", "com/de/")]

URL_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN ''
    ELSE substr(url, instr(url, '://') + 3) END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rule, rhost, rpath, verdict) AS (VALUES
  ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
  ('com/de/', 'com', '/de/', 'block')),
best AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM h JOIN r ON ends_with('.' || host, '.' || rhost) AND starts_with(path, rpath) GROUP BY page_id)
SELECT h.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM h LEFT JOIN best USING (page_id)
"""


@query("op10_url_filter", URL_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES).drop("url")


@query("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where the exact sum (``deviation_exact``) outgrows a long."""
    out = whitening.whitened_embeddings(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return out.select("vec_id", "component", "n", F.col("deviation").try_cast("long").alias("deviation"), "whitened",
                      "explained", "identity_error", F.col("deviation").alias("deviation_exact"))


@query("op12_lm_scoring")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null doc_id is not held out."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    scored = context_tree.score_documents(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score", "n_bytes", "bits_per_byte")


def _repair_sql() -> str:
    """The edits as a recursion over a conversation's rows: four paths, each
    ``{cost, audit, text}``; the least struct is the cheapest, then ASCII-least one."""
    spoken = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    kept = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def path(before: str, cost: str, letter: str, line: str | None) -> str:
        text = f"{before}.txt" if line is None else \
            f"CASE WHEN {before}.txt IS NULL THEN {line} ELSE {before}.txt || chr(10) || {line} END"
        return (f"{{'cost': {before}.cost + {cost}, 'audit': {before}.audit || '{letter}', 'txt': {text}}}")

    def least(options: list[tuple[str, str]]) -> str:
        """Of ``(condition, path)`` the least whose condition holds."""
        each = ", ".join(f"CASE WHEN {when} THEN {p} END" for when, p in options)
        return f"list_min(list_filter([{each}], lambda x: x IS NOT NULL))"

    stays = "CASE WHEN truncated THEN 5 ELSE 0 END"
    moved = []
    for to in range(4):
        options = [(f"p{to} IS NOT NULL", path(f"p{to}", "2", "D", None))]
        for at in range(4):
            for initial, place in kept[at].items():
                if place == to:
                    options.append((f"p{at} IS NOT NULL AND NOT must_go AND initial = '{initial}'",
                                    path(f"p{at}", f"({stays})", "K", "role || ':' || text")))
            if spoken[at][1] == to:
                options.append((f"p{at} IS NOT NULL AND NOT must_go",
                                path(f"p{at}", f"(1 + {stays})", "R", f"'{spoken[at][0]}:' || text")))
        moved.append(f"{least(options)} AS p{to}")
    user = least([("p2 IS NOT NULL", "p2")] + [(f"p{at} IS NOT NULL", path(f"p{at}", "5", "I", "'user:'"))
                                              for at in (0, 1, 3)])
    assistant = least([("p3 IS NOT NULL", "p3"), ("p2 IS NOT NULL", path("p2", "5", "I", "'assistant:'"))])
    nothing = "CAST(NULL AS STRUCT(cost INTEGER, audit VARCHAR, txt VARCHAR))"
    start = "{'cost': 0, 'audit': '', 'txt': CAST(NULL AS VARCHAR)}"
    return rf"""
WITH RECURSIVE
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')) AS key
  FROM conversations),
crc AS (
  SELECT *, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(range(octet_length(key)),
      lambda i: CAST('0x' || hex(key)[2 * i + 1:2 * i + 2] AS BIGINT))),
    lambda acc, b: list_reduce(list_concat([xor(acc, b)], range(8)),
      lambda x, bit: xor(x >> 1, (x & 1) * 3988292384)))) % 20 AS h
  FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy
  FROM crc WHERE h <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
    trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core
  FROM damaged),
judged AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS initial, core = '' AS blank, core <> '' AND seen AS duplicate,
    core <> '' AND NOT seen AND right(core, 1) NOT IN ('.', '!', '?') AS truncated, core = '' OR seen AS must_go,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
steps(conv_id, i, p0, p1, p2, p3) AS (
  SELECT conv_id, 0, p0, p1, {user} AS p2,
    {nothing} AS p3 FROM (SELECT DISTINCT conv_id, {start} AS p0, {nothing} AS p1, {nothing} AS p2, {nothing} AS p3
    FROM judged)
  UNION ALL
  SELECT conv_id, i, p0, p1, p2, {assistant} AS p3 FROM (
    SELECT conv_id, i, p0, p1, {user} AS p2, p3 FROM (
      SELECT j.conv_id, j.i, {", ".join(moved)}
      FROM steps s JOIN judged j ON s.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = s.i + 1))),
ends AS (
  SELECT conv_id, list_min(list_filter([p0, p3], lambda x: x IS NOT NULL)) AS p
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS last FROM steps) WHERE last = 1),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
    count_if(duplicate) AS duplicate, count_if(truncated) AS truncated,
    count_if(i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(p.cost, 0) AS BIGINT) AS cost,
  coalesce(p.audit, '') AS audit, sha256(coalesce(p.txt, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counted c ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ends e ON a.conv_id IS NOT DISTINCT FROM e.conv_id
"""


@query("op13_conversation_repair", _repair_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(
        conversation_repair.damage(table(spark, sf_dir, "conversations")), gone="gone")
