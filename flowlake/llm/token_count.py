"""Token counts by heap-and-linked-list byte-pair merging.

The vocabulary and its merge order come from a sentencepiece BPE model file;
the text is never encoded to ids.  Symbols of a segment form a doubly linked
list, a heap holds the adjacent pairs that are pieces, and the best pair (the
lowest rank: highest score, then leftmost) is merged until none is left.  The
count is the initial symbols minus the merges, where a character outside the
vocabulary counts its UTF-8 bytes (byte fallback).

No piece has a space mark after another character, nor a line feed; the merger
checks this on loading.  So no merge crosses the start of a word, and a text's
count is the sum over its words.  Words repeat, so counts of words are kept in
a bounded cache, which changes the speed only.

Null text counts as empty: 0 bytes, 0 tokens.  Repeated rows are counted each.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import worker_state

MARK = "▁"
_RUNS = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


class PieceMerger(dict):
    """Word -> number of tokens; a missing word is merged and remembered."""

    def __init__(self, model_file: str, keep_words: int = 1_000_000):
        import sentencepiece

        super().__init__()
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.keep_words = keep_words
        self.rank: dict[str, float] = {}
        for i in range(sp.get_piece_size()):
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)):
                self.rank[sp.id_to_piece(i)] = -sp.get_score(i)
        self.by_word = not any(re.search(f"[^{MARK}]{MARK}|\n", p) for p in self.rank)
        self[""] = 0

    def __missing__(self, segment: str) -> int:
        if len(self) >= self.keep_words:
            self.clear()
            self[""] = 0
        n = self.merge_count(segment)
        self[segment] = n
        return n

    def merge_count(self, segment: str) -> int:
        rank, symbols = self.rank, list(segment)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[float, int, int]] = []

        def offer(left: int, right: int) -> None:
            joined = symbols[left] + symbols[right]
            if joined in rank:
                heapq.heappush(heap, (rank[joined], left, len(joined)))

        for i in range(n - 1):
            offer(i, i + 1)
        merges = 0
        while heap:
            _, left, size = heapq.heappop(heap)
            right = after[left] if symbols[left] else n
            if right >= n or len(symbols[left]) + len(symbols[right]) != size:
                continue  # one of the two was merged meanwhile
            symbols[left] += symbols[right]
            symbols[right] = ""
            merges += 1
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        initial = sum(1 if c in rank else len(c.encode()) for c in segment)
        return initial - merges

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        marked = MARK + text.replace(" ", MARK)
        if not self.by_word:
            return self[marked]
        if MARK + MARK in marked:
            return sum(map(self.__getitem__, _RUNS.findall(marked)))
        words = marked.replace(MARK, " " + MARK).replace("\n", " \n ").split(" ")
        return sum(map(self.__getitem__, words))


def count_tokens(df: DataFrame, model_file: str, text_col: str = "text",
                 into: str = "n_tokens") -> DataFrame:
    """Add ``into``: tokens of the whole text.  ``model_file`` is a path that
    every worker can open (the tokenizer package is installed on each)."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        merger = worker_state("pieces:" + model_file, lambda: PieceMerger(model_file))
        for texts in batches:
            yield pd.Series(np.fromiter(map(merger.count, texts), np.int64, len(texts)))

    return df.withColumn(into, F.pandas_udf(run, "long")(F.col(text_col)))
