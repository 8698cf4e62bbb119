"""N-gram Jaccard self-join by T-occurrence search (DivideSkip).

Words are runs other than space and 0x09-0x0D of the whole text with A-Z
lower-cased; a document's set holds its distinct 5-word shingles as 64-bit hashes (fewer
words: the whole sequence as one element; no words: empty, linked with nothing).
Two documents link when 100 * intersection >= 75 * union.

1. One pass over the text: set size n, set fingerprint and the set's smallest hashes.
   Of a linked pair the smaller set lacks at most n/7 of its elements in the other, the
   larger at most n/4.  So the first k common elements lie among the smaller set's first
   n/7 + k elements (its core) and among the larger one's first n/4 + k (its prefix).
   k is a tenth of the set.  Copies (equal sets) are one node; per batch only the first
   sends its prefix.
2. Elements that two nodes hold, one of them in its core, are found by one shuffle of the
   postings (those of the hottest elements stay where they are) and counted per node.  A node
   with fewer than k such elements in its core is nobody's smaller partner; one with
   fewer than the least k of its partners among those cores is nobody's larger one.
   Both are exact bounds: documents that merely share a passage end here.  The elements
   left get their smallest holder as centre (partial aggregates: a hot element is summed
   map-side).  A smaller partner shares k elements, so it may give up any k - 1: those of
   the centres it meets least.  An element that a smaller partner keeps puts its holders
   of a size that could link with such a one in the block of its centre.
   A block whose nodes all lie in another one is left out.
   Blocks whose sets are together large are cut into chunks, and chunks meet pairwise.
3. Per block (or pair of chunks): inverted lists, and for each set the T-occurrence
   search for partners of its size or more.  T is the least overlap any of them needs.
   The longest lists (hot passages) are left out; the short ones are heap-merged with
   skips, and documents that reach T less the lists left out are looked up in the long
   ones by binary search until they reach the overlap that the pair needs or can't any
   more.  Documents already connected to the searching one are left out of its lists, so
   a group of thousands of near copies costs one comparison each, not one a pair.
4. Components of the links; each node's result goes back to its copies.

The result is exact up to 64-bit hash equality; no pair of different components that
links is lost, and no list, block or group is capped.  Null or empty text: empty set.
Rows repeating an id are one document each; null ids get null as the smallest only
if their whole component has none.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowlake.llm.common import mix, ordered_hash, sequence_hash, sorted_groups, word_hashes, written
from flowlake.llm.components import components

WIDTH = 5
PERCENT = 75
CHUNK_ELEMENTS = 3_000_000   # set elements that one side of a block may hold
BITMAP_BITS = 1 << 25        # fixed size of the filter sent to the workers
HOT_ELEMENTS = 100_000       # an element with more than this share of the postings is hot
HOT_SLICE = 64               # one set in so many tells the hot elements
MU = 0.0085                  # DivideSkip's weight of a heap step against a probe


# --- sets --------------------------------------------------------------------

def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (int64) of each text."""
    out = []
    for words in word_hashes([(t or "").encode().lower() for t in texts]):
        if not len(words):
            out.append(np.zeros(0, np.int64))
        elif len(words) < width:
            out.append(np.array([sequence_hash(words)], np.uint64).view(np.int64))
        else:
            out.append(np.unique(ordered_hash(words, width).view(np.int64)))
    return out


def fingerprint(values: np.ndarray) -> int:
    """A hash of the set: a sum of mixed elements, mixed with the size."""
    total = np.sum(mix(values.view(np.uint64) ^ np.uint64(0xA0761D6478BD642F)), dtype=np.uint64)
    return int(mix(np.array([total + np.uint64(len(values))], np.uint64)).view(np.int64)[0])


def common_needed(n: int) -> int:
    """k: common elements looked for in the core of a set of n."""
    return max(1, n // 10)


def core_size(n: int, percent: int = PERCENT) -> int:
    return n - required(n, n, percent) + common_needed(n)


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + common_needed(n)


def required(n: int, m: int, percent: int = PERCENT) -> int:
    """Least intersection of sets of n and m elements that link."""
    return -(-percent * (n + m) // (100 + percent))


def _long_lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate([np.zeros(0, np.int64), *arrays]))


def _signatures(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``__id, n, fp, core, prefix`` (the core is the prefix's first ``core`` elements);
    the prefix only at a fingerprint's first row of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets = shingle_sets(part.column(1).to_pylist(), width)
                fps = [fingerprint(s) for s in sets]
                seen, prefixes = set(), []
                for s, fp in zip(sets, fps):
                    n = len(s)
                    first = n and fp not in seen
                    seen.add(fp)
                    prefixes.append(s[:prefix_size(n, percent)] if first else s[:0])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(fps, pa.int64()), pa.array([core_size(len(s), percent) for s in sets], pa.int64()),
                     _long_lists(prefixes)], ["__id", "n", "fp", "core", "prefix"])

    return docs.mapInArrow(run, f"__id {docs.schema['__id'].dataType.simpleString()}, n long, fp long, core long, prefix array<long>")


def _bitmap(keys: DataFrame, col: str) -> np.ndarray:
    """A fixed-size bitmap of the column's hashed values; it lets others through
    too, so an exact join follows wherever it is used."""
    slot = F.pmod(F.col(col), F.lit(BITMAP_BITS))
    bucket, bit = F.shiftright(slot, 15), slot.bitwiseAND(F.lit(32767))
    rows = (keys.select(bucket.alias("k"), bit.alias("p"))
            .groupBy("k").agg(F.bitmap_construct_agg("p").alias("m")).collect())
    bits = np.zeros(BITMAP_BITS // 8, np.uint8)
    for r in rows:
        bits[r["k"] * 4096:(r["k"] + 1) * 4096] = np.frombuffer(bytes(r["m"]), np.uint8)
    return bits


def bitmap_has(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    slot = values % BITMAP_BITS  # never negative, like pmod
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _shared_postings(signatures: DataFrame) -> DataFrame:
    """(element, fp, n, core), once each, of the prefix elements that two sets hold, one
    of them in its core.  Postings meet in one shuffle by element.  Those of the hottest
    elements don't move: which of them count is a partial aggregate of at most
    HOT_ELEMENTS rows.  The slice of sets that tells the hottest only decides the way."""
    held = signatures.select("fp", "n", "core", F.posexplode("prefix").alias("rank", "element")).select(
        "element", "fp", F.when(F.col("rank") < F.col("core"), F.col("n")).otherwise(-F.col("n")).alias("m"))
    some = (signatures.filter(F.pmod(F.xxhash64("fp"), F.lit(HOT_SLICE)) == 0)
            .select(F.explode("prefix").alias("element")).groupBy("element").agg(F.count("*").alias("__n")))
    total = some.agg(F.sum("__n")).first()[0] or 0
    hot = written(some.filter(F.col("__n") > max(1.0, total / HOT_ELEMENTS)).select("element"), "hot")

    counts = (F.min("fp"), F.max("fp"), F.max("m"))
    of_hot = held.join(F.broadcast(hot), "element")
    wanted = of_hot.groupBy("element").agg(*(c.alias(n) for c, n in zip(counts, ("__first", "__last", "__top"))))
    hot_rows = of_hot.join(F.broadcast(wanted.filter(_SHARED).select("element")), "element", "left_semi")

    same = Window.partitionBy("element")
    rows = held.join(F.broadcast(hot), "element", "left_anti").select(
        "*", *(c.over(same).alias(n) for c, n in zip(counts, ("__first", "__last", "__top")))).filter(_SHARED)
    once = [r.groupBy("element", "fp").agg(F.max("m").alias("m")) for r in (rows, hot_rows)]
    return once[0].union(once[1]).select("element", "fp", F.abs("m").alias("n"), (F.col("m") > 0).alias("core"))


_SHARED = "__first <> __last and __top > 0"


def _member_sets(docs: DataFrame, bits, width: int) -> DataFrame:
    """(fp, n, values) of the documents whose fingerprint the bitmap lets through,
    one per fingerprint and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                sets = shingle_sets(batch.slice(at, 1024).column(0).to_pylist(), width)
                fps = np.array([fingerprint(s) if len(s) else 0 for s in sets], np.int64)
                _, first = np.unique(fps, return_index=True)
                some = [i for i in first if len(sets[i]) and bitmap_has(bits.value, fps[i:i + 1])[0]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fps[some], pa.int64()), pa.array([len(sets[i]) for i in some], pa.int64()),
                     _long_lists([sets[i] for i in some])], ["fp", "n", "values"])

    return docs.select("__text").mapInArrow(run, "fp long, n long, values array<long>")


# --- T-occurrence search -----------------------------------------------------

def t_occurrence_links(sets: list[np.ndarray], side: np.ndarray | None = None,
                       percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect all linked sets (a spanning forest of them), as index
    pairs.  With ``side``, only sets of different sides are compared.

    Sets are ranked by size and each asks for partners of higher rank only.  Elements
    held by the same sets share one inverted list, whose weight for a set is the number
    of the set's elements behind it."""
    by_size = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in by_size], np.int64)
    _, token = np.unique(np.concatenate([sets[i] for i in by_size]), return_inverse=True)
    if not len(token):
        return []
    side = None if side is None else np.asarray(side)[by_size]
    owner = np.repeat(np.arange(len(sets)), sizes)
    posting = owner[np.argsort(token, kind="stable")]
    held = np.bincount(token)
    begin = np.cumsum(held) - held
    mixed = np.add.reduceat(mix(posting.astype(np.uint64) + np.uint64(1)), begin)
    _, first, kind = np.unique(mixed, return_index=True, return_inverse=True)
    begin, held = begin[first], held[first]
    own = np.split(kind[token], np.cumsum(sizes)[:-1])
    group = np.arange(len(sets))
    links = []
    for q, n in enumerate(sizes.tolist()):
        last = int(np.searchsorted(sizes, 100 * n // percent, "right"))   # partners are no larger
        open_ = group[q + 1:last] != group[q]
        if side is not None:
            open_ &= side[q + 1:last] != side[q]
        if not n or not open_.any():
            continue
        need = required(n, n, percent)        # T: the least overlap with a set of n or more
        lists, weight = np.unique(own[q], return_counts=True)
        some = held[lists] > 1
        lists, weight = lists[some], weight[some]
        if weight.sum() < need:
            continue
        order = np.argsort(-held[lists], kind="stable")
        lists, weight = lists[order], weight[order]
        budget = min(need - 1, int(need / (MU * math.log2(held[lists[0]]) + 1)))
        long_ = int(np.searchsorted(np.cumsum(weight), budget, "right"))   # the longest lists
        left_out = int(weight[:long_].sum())
        short, rank = [], []
        for s, k, w in zip(begin[lists[long_:]].tolist(), held[lists[long_:]].tolist(), weight[long_:].tolist()):
            one = posting[s:s + k]
            one = one[np.searchsorted(one, q, "right"):np.searchsorted(one, last)]
            one = one[open_[one - q - 1]]
            if len(one):
                short.append(one.tolist())
                rank.append(w)
        probes = sorted(zip(weight[:long_].tolist(), begin[lists[:long_]].tolist(), held[lists[:long_]].tolist()),
                        reverse=True)
        for p, hits in merge_skip(short, rank, need - left_out):
            if group[p] == group[q]:
                continue
            want, rest = required(n, int(sizes[p]), percent), left_out
            for w, s, k in probes:
                if hits >= want or hits + rest < want:
                    break
                rest -= w
                at = bisect_left(posting, p, s, s + k)
                if at < s + k and posting[at] == p:
                    hits += w
            if hits >= want:
                links.append((int(by_size[q]), int(by_size[p])))
                group[group == group[p]] = group[q]
    return links


def merge_skip(lists: list[list[int]], weight: list[int], need: int) -> Iterator[tuple[int, int]]:
    """Heap-merge of ascending lists: (document, weight of the lists that hold it) where
    that is ``need`` or more.  Lists that can't reach it together jump ahead."""
    at = [0] * len(lists)
    heap = [(x[0], i) for i, x in enumerate(lists)]
    heapq.heapify(heap)
    while heap:
        doc, hits, popped = heap[0][0], 0, []
        while heap and heap[0][0] == doc:
            i = heapq.heappop(heap)[1]
            popped.append(i)
            hits += weight[i]
        to = doc + 1
        if hits >= need:
            yield doc, hits
        else:
            while heap and hits + weight[heap[0][1]] < need:
                i = heapq.heappop(heap)[1]
                popped.append(i)
                hits += weight[i]
            if not heap:
                return
            to = heap[0][0]
        for i in popped:
            at[i] = bisect_left(lists[i], to, at[i])
            if at[i] < len(lists[i]):
                heapq.heappush(heap, (lists[i][at[i]], i))


def _members(hits: DataFrame, percent: int) -> DataFrame:
    """(centre, fp, n): the blocks of each node, so that two that link share one."""
    least = lambda n: F.greatest(F.floor(n / 10), F.lit(1))  # noqa: E731  common_needed
    shortest = F.ceil(F.col("n") * percent / 100)            # smallest set that links with one of n
    partners = (F.col("lo") <= F.col("n")) & (F.col("hi") >= shortest)
    sizes = F.min("n").alias("lo"), F.max("n").alias("hi")

    small = (hits.filter("core").groupBy("fp").agg(F.count("*").alias("__k"), F.max("n").alias("n"))
             .filter(F.col("__k") >= least(F.col("n"))).select("fp"))
    centres = (hits.filter("core").join(small, "fp", "left_semi").groupBy("element")
               .agg(F.min("fp").alias("centre"), *sizes))
    near = written(hits.join(centres, "element").filter(partners)
                   .select("element", "fp", "n", "core", "centre"), "near")
    large = (near.groupBy("fp").agg(F.count("*").alias("__k"), F.max("n").alias("n"))
             .filter(F.col("__k") >= least(shortest)).select("fp"))

    own = Window.partitionBy("fp")
    kept = (near.filter("core").join(small, "fp", "left_semi")
            .withColumn("__same", F.count("*").over(Window.partitionBy("fp", "centre")))
            .withColumn("__rank", F.row_number().over(own.orderBy("__same", "centre", "element")))
            .filter(F.col("__rank") >= least(F.col("n")))
            .groupBy("element").agg(F.min("centre").alias("centre"), *sizes))
    return (near.drop("centre").join(kept, "element").filter(partners).join(large, "fp", "left_semi")
            .groupBy("centre", "fp").agg(F.max("n").alias("n")))


def _search_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """Search every block of (centre, i, j, chunk, fp, values) rows, which arrive
    together and in order; links as (a, b) fingerprints."""

    def search(part: pd.DataFrame) -> list[tuple[int, int]]:
        part = part.drop_duplicates("fp")
        if len(part) < 2:
            return []
        sets = [np.asarray(v, np.int64) for v in part["values"]]
        cross = part["i"].iloc[0] != part["j"].iloc[0]
        fps = part["fp"].to_numpy()
        return [(int(fps[a]), int(fps[b])) for a, b in
                t_occurrence_links(sets, part["chunk"].to_numpy() if cross else None, percent)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in sorted_groups(batches, ["centre", "i", "j"]):
            if links := search(block):
                yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return (rows.repartition("centre", "i", "j").sortWithinPartitions("centre", "i", "j", "fp")
            .mapInPandas(run, "a long, b long"))


def _outer_blocks(members: DataFrame) -> DataFrame:
    """``centre, __total, __nodes`` of the blocks of (centre, fp, n) rows that hold two
    nodes or more and whose nodes aren't all in a block of a smaller centre."""
    sizes = written(members.groupBy("centre").agg(F.sum("n").alias("__total"), F.count("*").alias("__nodes"))
                    .filter("__nodes > 1"), "blocks")
    nodes = sizes.select("centre", "__nodes")
    around = (members.select(F.col("fp").alias("centre"), F.col("centre").alias("__outer")).filter("__outer < centre")
              .join(nodes, "centre").join(nodes.toDF("__outer", "__around"), "__outer")
              .filter("__around >= __nodes").select("centre", "__outer", "__nodes"))
    covered = (members.select("centre", "fp").join(around, "centre")
               .join(members.select(F.col("centre").alias("__outer"), "fp"), ["__outer", "fp"], "left_semi")
               .groupBy("centre", "__outer").agg(F.count("*").alias("__k"), F.max("__nodes").alias("__nodes"))
               .filter("__k = __nodes").select("centre"))
    return sizes.join(covered, "centre", "left_anti")


# --- the operator ------------------------------------------------------------

def join_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_shingles`` and ``component_id``."""
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    signatures = written(_signatures(plain, width, percent), "signatures")

    hits = written(_shared_postings(signatures), "hits")
    members = written(_members(hits, percent), "members")

    blocks = _outer_blocks(members)
    chunks = (blocks
              .select("centre", F.ceil(F.col("__total") / CHUNK_ELEMENTS).cast("int").alias("chunks")))
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    placed = members.join(chunks, "centre").withColumn("chunk", chunk)
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    tiles = (placed.select("fp", "centre", "chunk", other.alias("__other"))
             .select("fp", "centre", "chunk", F.least("chunk", "__other").alias("i"),
                     F.greatest("chunk", "__other").alias("j")))
    wanted = spark.sparkContext.broadcast(_bitmap(members, "fp"))
    sets = _member_sets(plain, wanted, width)
    links = written(_search_blocks(tiles.join(sets.select("fp", "values"), "fp"), percent), "links")

    linked = components(links)
    smallest = (signatures.filter("n > 0").groupBy("fp").agg(F.min("__id").alias("low")))
    known = smallest.join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    roots = (known.filter(F.col("root").isNotNull()).join(linked.select("root").distinct(), "root", "left_semi")
             .groupBy("root").agg(F.min("low").alias("least")))
    classes = (known.join(roots, "root", "left")
               .select("fp", F.coalesce("least", "low").alias("component_id")))
    found = signatures.select("__id", F.col("n").alias("n_shingles"), "fp")
    return (found.join(classes, "fp", "left")
            .select(F.col("__id").alias(id_col), "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("__id")).alias("component_id")))
