"""Best-two-fit packing of tokenised documents into fixed-length sequences.

1. Documents become pieces: token ids, then the end id; only documents longer
   than the capacity are cut.  Pieces are written once (no ids, just digests).
2. One Spark aggregate counts pieces per length: at most ``capacity`` rows,
   whatever the corpus holds.
3. ``plan_bins`` packs that histogram.  Pieces of a length are alike, so a bin is
   a multiset of lengths, and a bin made once is repeated for as long as the
   lengths it draws on last; that is bin-by-bin packing of the whole corpus.
   - greedy: put in the longest piece that fits until none does;
   - best two fit: take the bin's smallest piece out again and put in the two
     unpacked pieces that fill the widened gap best, if they fill it better.
4. Each piece gets its rank within its length (ranks run over hashed slices of
   the length, so a length that a third of all rows share is spread) and looks
   its place up in the plan.

The plan's size depends on the capacity only, so it may be broadcast.

Null text is an empty document (the end id alone).  Repeated rows are packed
each; null ids are kept.  An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowlake.llm.common import worker_state, written

CAPACITY = 2048
SLICES = 256
BATCH_ROWS = 256
PIECE_SCHEMA = "__id {id}, piece int, start long, length long, ids_crc32 long"


# --- tokens ------------------------------------------------------------------

class WordIds(dict):
    """Word -> its token ids as little-endian bytes, by the tokenizers library.

    The tokenizer drops white space and never merges across it, so a text's
    ids are its words' ids in a row.  Only texts that hold one of the special
    strings are encoded whole."""

    _ascii = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)

    def __init__(self, file: str, keep_words: int = 1_000_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        self.parts: dict[str, bytes] = {}
        self.keep_words = keep_words
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        probe = ["It's 10 o'clock, isn't it?!  (yes)", "x_y-z\x1ca'd'llama 'tis ...7a"]
        self.by_part = all(b"".join(map(self._by_part, s.split(" "))) == self._whole(s) for s in probe)
        self[""] = b""

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _by_part(self, word: str) -> bytes:
        """An ASCII word: split as the tokenizer's own rule splits it, each part
        through the library's model."""
        out = []
        for part in self._ascii.findall(word.lower()):
            ids = self.parts.get(part)
            if ids is None:
                if any(c < "!" or c > "~" for c in part):
                    return self._whole(word)
                ids = np.array([t.id for t in self.model.tokenize(part)], "<u4").tobytes()
                self.parts[part] = ids
            out.append(ids)
        return b"".join(out)

    def __missing__(self, word: str) -> bytes:
        if len(self) + len(self.parts) >= self.keep_words:
            self.clear()
            self.parts.clear()
            self[""] = b""
        ids = self._by_part(word) if self.by_part and word.isascii() else self._whole(word)
        self[word] = ids
        return ids

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self._whole(text)
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def tokenised_pieces(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id",
                     text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0,
                     with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``__id, piece, start, length,
    ids_crc32`` and, on request, the ids themselves."""
    schema = PIECE_SCHEMA.format(id=docs.schema[id_col].dataType.simpleString())
    if with_ids:
        schema += ", ids binary"
    end = np.array([end_id], "<u4").tobytes()

    names = ["__id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_state("word_ids:" + tokenizer_file, lambda: WordIds(tokenizer_file))
        width = 4 * capacity
        types = [None, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_ROWS):      # few texts are Python objects at a time
                some = batch.slice(first, BATCH_ROWS)
                types[0] = some.column(0).type
                rows = []
                for key, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    ids = words.ids(text) + end
                    for k, at in enumerate(range(0, len(ids), width)):
                        part = ids[at:at + width]
                        row = (key, k, at // 4, len(part) // 4, zlib.crc32(part))
                        rows.append((*row, part) if with_ids else row)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).mapInArrow(run, schema)


# --- the plan ----------------------------------------------------------------

def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Best two fit over a histogram: ``(times, {length: pieces in the bin})``.

    Lengths must lie in 1..capacity; counts of zero are ignored."""
    left = {n: c for n, c in counts.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError(f"lengths must lie in 1..{capacity}")
    lengths = sorted(left)
    bins: list[tuple[int, dict[int, int]]] = []
    while lengths:
        drawn: dict[int, int] = {}
        gap, top = capacity, len(lengths)
        while gap:
            top = bisect_right(lengths, gap, 0, top)
            if not top:
                break
            n = lengths[top - 1]
            take = min(left[n], gap // n)
            drawn[n] = take
            gap -= take * n
            top -= 1
        final, peak = dict(drawn), dict(drawn)
        smallest = min(drawn)
        if gap and sum(drawn.values()) > 1:
            pair = _best_pair(lengths, left, drawn, gap + smallest, smallest)
            if pair:
                final[smallest] -= 1
                for n in pair:
                    final[n] = final.get(n, 0) + 1
                    peak[n] = peak.get(n, 0) + 1
                final = {n: k for n, k in final.items() if k}
        times = min((left[n] - peak[n]) // k + 1 for n, k in final.items())
        bins.append((times, final))
        for n, k in final.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
                lengths.remove(n)
    return bins


def _best_pair(lengths: list[int], left: dict[int, int], drawn: dict[int, int],
               gap: int, smallest: int) -> tuple[int, int] | None:
    """Two unpacked lengths with the largest sum in (smallest, gap]; of equal
    sums the one with the longer first length."""
    best, found = smallest, None
    free = [n for n in lengths[:bisect_right(lengths, gap)] if left[n] > drawn.get(n, 0)]
    i, j = 0, len(free) - 1
    while i <= j:
        total = free[i] + free[j]
        if total > gap:
            j -= 1
        else:
            if total > best and (i < j or left[free[i]] - drawn.get(free[i], 0) > 1):
                best, found = total, (free[j], free[i])
                if best == gap:
                    break
            i += 1
    return found


def placements(bins: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows ``(length, from_rank, to_rank, per_bin, first_sequence, first_offset)``."""
    rows, used, sequence = [], {}, 0
    for times, content in bins:
        offset = 0
        for n in sorted(content, reverse=True):
            k, start = content[n], used.get(n, 0)
            rows.append((n, start, start + times * k, k, sequence, offset))
            used[n] = start + times * k
            offset += k * n
        sequence += times
    return rows


# --- the operator ------------------------------------------------------------

def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` column.

    ``pieces`` is read three times; pass a written table."""
    spark = pieces.sparkSession
    slot = F.pmod(F.xxhash64("__id", "piece", "ids_crc32"), F.lit(SLICES)).cast("int")
    sliced = pieces.withColumn("__slice", slot)
    sizes = sliced.groupBy("length", "__slice").agg(F.count("*").alias("__n"))
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    plan = spark.createDataFrame(
        placements(plan_bins(histogram, capacity)) or [(0, 0, 0, 1, 0, 0)],
        "__length long, __from long, __to long, __per long, __sequence long, __offset long")
    before = sizes.select(
        F.col("length").alias("__l"), F.col("__slice").alias("__s"),
        (F.sum("__n").over(Window.partitionBy("length").orderBy("__slice")) - F.col("__n")).alias("__before"))
    within = Window.partitionBy("length", "__slice").orderBy("__id", "piece", "ids_crc32")
    ranked = (sliced.withColumn("__rank", F.row_number().over(within) - 1)
              .join(before, (F.col("length") == F.col("__l")) & (F.col("__slice") == F.col("__s")))
              .withColumn("__rank", F.col("__rank") + F.col("__before")))
    placed = ranked.join(F.broadcast(plan), (F.col("length") == F.col("__length"))
                         & (F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to")))
    nth = F.col("__rank") - F.col("__from")
    return placed.select(
        *pieces.columns,
        (F.col("__sequence") + F.expr("(__rank - __from) div __per")).alias("sequence_id"),
        (F.col("__offset") + (nth % F.col("__per")) * F.col("length")).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id",
                   text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack ``docs``: one row per piece with its place."""
    pieces = written(tokenised_pieces(docs, tokenizer_file, id_col, text_col, capacity), "pieces")
    return pack(pieces, capacity).withColumnRenamed("__id", id_col)
