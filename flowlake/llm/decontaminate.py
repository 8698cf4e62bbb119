"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit check.

Texts are word sequences (runs of letters and digits, lower-cased).  A CGK walk
reads a window: step j emits the current word, then moves on by a random bit that
depends on j and the word alone.  Two windows a few edits apart fall back into step, so
their edit distance becomes a small Hamming distance between what they emit.  Bit sampling
hashes some of the emitted places; each repetition walks with its own bits and samples
its own places.

Windows start at each word of an item and of a document, in every repetition.  They grow
with the item: ``CLASSES`` gives the samples of a key by the item's words, about two
steps apart, and a key that would need a word past the item's end is not made.  A walk stops as soon as
what it sampled so far begins no item's key.  CLASSES and REPETITIONS are set for
``TARGET_RECALL`` of the items whose words were changed, dropped or added at random up to
``MAX_RATIO``; the tests measure it.  A hit proposes a place for the item; the item is then compared
with the item-sized window there by its exact edit distance in bytes of UTF-8
(bit-parallel, any end points), and reported if that is at most ``max_ratio`` of its length.

Items of fewer than WALKED_WORDS words, or of words of more than LONG_WORD bytes on average
(scripts that don't space their words), are found by their bytes without loss: cut into
tiles of q bytes, an item within k edits keeps all but k tiles unchanged, on diagonals at
most k apart; places with so many tiles go to the edit check.

Items are taken in blocks of ``BLOCK_ITEMS``, so what is sent to the workers is
bounded; every block sees all documents.  Items of fewer than MIN_BYTES bytes are not
searched.  Null or empty text or items: no match.  Repeated rows are judged each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import PUNCTUATION_BYTES, mix, word_hashes

TARGET_RECALL = 0.95
#: From so many words of an item on, so many samples a key.
CLASSES = ((12, 7), (20, 8), (40, 10))
REPETITIONS = 16
STEPS = 3 * CLASSES[-1][1]
WALKED_WORDS = CLASSES[0][0]
LONG_WORD = 16
MIN_BYTES = 10
MAX_RATIO = 0.2
BLOCK_ITEMS = 20_000
FILTER_BITS = 1 << 22
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
MATCHES = "array<struct<item_id:{id},first_word:long,distance:long,length:long>>"


def normalised(text: str) -> list[bytes]:
    return _WORD.findall(text.lower().encode())


def _places(repetition: int) -> list[int]:
    """Sampled steps of a repetition: the first, and each two or three steps after the last."""
    rng = np.random.default_rng(1000 + repetition)
    return [0, *np.cumsum(rng.integers(2, 4, CLASSES[-1][1] - 1)).tolist()]


def walk(words: np.ndarray, starts: np.ndarray, repetition: int) -> Iterator[tuple]:
    """Per sampled step after the first: (samples so far, which starts, place read there,
    key of the samples).  The caller sends back which of these walks go on.  ``words`` must
    go on for STEPS words after the last start."""
    rng = np.random.default_rng(2000 + repetition)
    bits = rng.integers(0, 1 << 64, STEPS, np.uint64) | np.uint64(1)   # word hashes are mixed: a product's top bit is a coin
    at, which = starts, np.arange(len(starts))
    key, j = words[at] + bits[-1], 0
    for level, step in enumerate(_places(repetition)[1:], 2):
        while j < step:
            at = at + (words[at] * bits[j] >> np.uint64(63)).view(np.int64)
            j += 1
        key = key * np.uint64(0xD6E8FEB86659FD93) + words[at]
        on = yield level, which, at, key
        at, which, key = at[on], which[on], key[on]


def samples_of(n_words: int) -> int:
    return max(k for least, k in CLASSES if n_words >= least)


class Bits:
    """A set of FILTER_BITS bits, eight to a byte, addressed by the low bits of keys."""

    def __init__(self):
        self.packed = np.zeros(FILTER_BITS >> 3, np.uint8)

    @staticmethod
    def _places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = (keys & np.uint64(FILTER_BITS - 1)).astype(np.uint32)
        return low >> np.uint32(3), np.uint8(1) << (low & np.uint32(7)).astype(np.uint8)

    def add(self, keys: np.ndarray) -> None:
        at, bit = self._places(keys)
        np.bitwise_or.at(self.packed, at, bit)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at, bit = self._places(keys)
        return (self.packed[at] & bit) != 0


@dataclass
class Tiles:
    """Tiles of q bytes of the items that are found by their bytes."""
    q: int
    codes: np.ndarray             # ascending
    owner: np.ndarray
    offset: np.ndarray
    bitmap: np.ndarray

    @staticmethod
    def build(q: int, owners: list[int], texts: list[bytes]) -> "Tiles":
        codes = [grams(texts[i], q)[::q] for i in owners]
        owner = np.repeat(owners, [len(c) for c in codes])
        offset = np.concatenate([np.arange(len(c)) * q for c in codes])
        flat = np.concatenate(codes)
        order = np.argsort(flat, kind="stable")
        bitmap = Bits()
        bitmap.add(mix(flat))
        return Tiles(q, flat[order], owner[order], offset[order], bitmap)

    def hits(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(item, diagonal) of each tile found in the text, ascending."""
        code = grams(text, self.q)
        some = np.flatnonzero(self.bitmap.has(mix(code)))
        low, high = (np.searchsorted(self.codes, code[some], side) for side in ("left", "right"))
        n = high - low
        tile = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - low, n)
        item, diagonal = self.owner[tile], np.repeat(some, n) - self.offset[tile]
        order = np.lexsort((diagonal, item))
        return item[order], diagonal[order]


@dataclass
class Items:
    """A block of benchmark items with their sorted window keys and tiles."""
    ids: list
    texts: list[bytes]
    keys: np.ndarray
    owner: np.ndarray
    offset: np.ndarray
    bitmaps: dict[int, Bits]     # by samples: begins some item's key
    tiles: list[Tiles]
    begins: dict[int, list[int]]        # byte offsets of the words of walked items

    @staticmethod
    def build(rows: list[tuple[object, str]], max_ratio: float = MAX_RATIO) -> "Items":
        ids, texts, walked = [], [], []
        tiled: dict[int, list[int]] = {}
        for item, text in rows:
            words = normalised(text)
            spelled = b" ".join(words)
            if len(spelled) < MIN_BYTES:
                continue
            ids.append(item)
            texts.append(spelled)
            if len(words) < WALKED_WORDS or len(spelled) > (LONG_WORD + 1) * len(words):
                edits = int(max_ratio * len(spelled))
                q = next((q for q in (3, 2) if len(spelled) // q > edits), 1)
                tiled.setdefault(q, []).append(len(ids) - 1)
            else:
                walked.append(len(ids) - 1)
        hashed = word_hashes([texts[i] for i in walked])
        sizes = np.array([len(h) for h in hashed], np.int64)
        ends = np.repeat(np.cumsum(sizes), sizes)
        of = np.repeat(np.array(walked, np.int64), sizes)
        place = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        samples = np.repeat(np.array([samples_of(n) for n in sizes], np.int64), sizes)
        words = np.concatenate([*hashed, np.zeros(STEPS, np.uint64)])
        bitmaps = {k: Bits() for k in range(1, CLASSES[-1][1] + 1)}
        bitmaps[1].add(words[:len(of)])
        found = []
        for r in range(REPETITIONS):
            going = walk(words, np.arange(len(of)), r)
            level, which, at, key = next(going)
            while True:
                inside = (at < ends[which]) & (level <= samples[which])
                bitmaps[level].add(key[inside])
                whole = inside & (level == samples[which])
                found.append((key[whole], of[which[whole]], place[which[whole]]))
                try:
                    level, which, at, key = going.send(inside)
                except StopIteration:
                    break
        key, owner, offset = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(key, kind="stable")
        return Items(ids, texts, key[order], owner[order], offset[order], bitmaps,
                     [Tiles.build(q, owners, texts) for q, owners in sorted(tiled.items())],
                     {i: np.cumsum([0] + [len(w) + 1 for w in texts[i].split(b" ")]).tolist() for i in walked})

    def proposals(self, texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
        """Per text (its word hashes): (item, word of the text, word of the item) that share
        some window key, ascending."""
        out: list[set] = [set() for _ in texts]
        if not len(self.keys):
            return [[] for _ in texts]
        sizes = np.array([len(t) for t in texts], np.int64)
        begin = np.cumsum(sizes + STEPS) - (sizes + STEPS)
        pad = mix(np.arange(STEPS, dtype=np.uint64) + np.uint64(1 << 60))
        padded = np.concatenate([x for t in texts for x in (t, pad)])
        starts = np.flatnonzero(self.bitmaps[1].has(padded))
        whole = {k for _, k in CLASSES}
        for r in range(REPETITIONS):
            going = walk(padded, starts, r)
            level, which, _, key = next(going)
            while True:
                on = self.bitmaps[level].has(key)
                if level in whole:
                    some = np.flatnonzero(on)
                    low, high = np.searchsorted(self.keys, key[some]), np.searchsorted(self.keys, key[some], "right")
                    hit = high > low
                    place = starts[which[some[hit]]]
                    text = np.searchsorted(begin, place, "right") - 1
                    for t, p, a, b in zip(text, place - begin[text], low[hit], high[hit]):
                        out[t].update((int(self.owner[i]), int(p), int(self.offset[i])) for i in range(a, b))
                try:
                    level, which, _, key = going.send(on)
                except StopIteration:
                    break
        return [sorted(x) for x in out]

    def _nearest(self, item: int, diagonals: np.ndarray, text: bytes, edits: int) -> tuple[int, int] | None:
        """(distance, first word) of the nearest place within ``edits`` that starts at most
        ``edits`` bytes from one of the ascending diagonals."""
        pattern, best, at = self.texts[item], None, 0
        while at < len(diagonals):
            first = int(diagonals[at])
            at = int(np.searchsorted(diagonals, first + edits, "right"))  # the window holds theirs too
            window = text[max(0, first - edits):max(0, first + len(pattern) + 3 * edits)]
            d = _distance(pattern, window, edits)
            if d is not None and (best is None or d < best[0]):
                best = d, text.count(b" ", 0, max(0, first))
                if not d:
                    break
        return best

    def _tiled(self, text: bytes, max_ratio: float) -> Iterator[tuple[int, np.ndarray]]:
        """Items found by their bytes, with the diagonals that hold enough of their tiles."""
        for tiles in self.tiles:
            item, diagonal = tiles.hits(text)
            bounds = np.flatnonzero(np.diff(item, prepend=-1, append=-1)) if len(item) else []
            for low, high in zip(bounds[:-1], bounds[1:]):
                i, d = int(item[low]), diagonal[low:high]
                size = len(self.texts[i])
                need = max(1, size // tiles.q - int(max_ratio * size))
                if len(d) >= need:
                    yield i, d[:len(d) - need + 1][d[need - 1:] - d[:len(d) - need + 1] <= int(max_ratio * size)]

    def matches(self, text: str, proposed: list[tuple[int, int, int]], max_ratio: float) -> list[tuple]:
        """Verified (item id, first word, distance, item length), the nearest per item."""
        if not proposed and not self.tiles:
            return []
        words = normalised(text or "")
        spelled = b" ".join(words)
        places: dict[int, list[int]] = {}
        if proposed:
            begin = np.cumsum([0] + [len(w) + 1 for w in words])
            for item, place, offset in proposed:
                places.setdefault(item, []).append(int(begin[place]) - self.begins[item][offset])
        found = [(i, np.unique(d)) for i, d in places.items()]
        found += self._tiled(spelled, max_ratio)
        out = []
        for i, diagonals in sorted(found, key=lambda x: x[0]):
            size = len(self.texts[i])
            best = self._nearest(i, diagonals, spelled, int(max_ratio * size))
            if best:
                out.append((self.ids[i], best[1], best[0], size))
        return out


def grams(text: bytes, q: int) -> np.ndarray:
    """Every run of q bytes (at most 4) as a number."""
    b = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = max(0, len(b) - q + 1)
    out = b[:n]
    for k in range(1, q):
        out = out << np.uint64(8) | b[k:k + n]
    return out


def _distance(pattern: bytes, window: bytes, edits: int) -> int | None:
    """substring_distance, or None above ``edits``."""
    # an edit spoils three trigrams at most
    if np.isin(grams(pattern, 3), grams(window, 3)).sum() < len(pattern) - 2 - 3 * edits:
        return None
    d = substring_distance(pattern, window)
    return d if d <= edits else None


def substring_distance(pattern: bytes, text: bytes) -> int:
    """Least edit distance between the pattern and any substring of the text
    (bit-parallel columns of the dynamic programme)."""
    m = len(pattern)
    if not m:
        return 0
    where: dict[int, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << m - 1
    up, down, score = full, 0, m
    best = m
    for c in text:
        eq = where.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        right_up = down | (~(diagonal | up) & full)
        right_down = up & diagonal
        if right_up & top:
            score += 1
        elif right_down & top:
            score -= 1
        right_up = (right_up << 1) & full
        right_down = (right_down << 1) & full
        up = right_down | (~(diagonal | right_up) & full)
        down = right_up & diagonal
        if score < best:
            best = score
            if not best:
                break
    return best


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                block: int = BLOCK_ITEMS, max_ratio: float = MAX_RATIO) -> Iterator[Items]:
    """The benchmark in blocks of at most ``block`` items, one on the driver at a time."""
    known = benchmark.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    blocks = max(1, -(-known.count() // (block // 2 or 1)))
    slot = F.pmod(F.xxhash64("i", "t"), F.lit(blocks))
    for k in range(blocks):
        rows = known.filter(slot == k).orderBy("i", "t").collect()
        if rows:
            yield Items.build([(r["i"], r["t"]) for r in rows], max_ratio)


def _match_column(spark, items: Items, text: Column, id_type: str, max_ratio: float) -> Column:
    sent = spark.sparkContext.broadcast(items)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        block = sent.value
        for texts in batches:
            values = texts.tolist()
            out = []
            for at in range(0, len(values), 512):
                some = values[at:at + 512]
                hashed = word_hashes([(t or "").lower().encode() for t in some], PUNCTUATION_BYTES)
                out += [[dict(zip(("item_id", "first_word", "distance", "length"), m))
                         for m in block.matches(t, found, max_ratio)]
                        for t, found in zip(some, block.proposals(hashed))]
            yield pd.Series(out, dtype=object)

    return F.pandas_udf(run, MATCHES.format(id=id_type))(text)


def with_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", max_ratio: float = MAX_RATIO, into: str = "leaks") -> DataFrame:
    """Add ``into``: the benchmark items found in each text (item, place, distance,
    item length), from all blocks of the benchmark."""
    id_type = benchmark.schema[item_col].dataType.simpleString()
    columns = [c for c in docs.columns if c != into]
    found = [_match_column(docs.sparkSession, items, F.col(text_col), id_type, max_ratio)
             for items in item_blocks(benchmark, item_col, item_text_col, max_ratio=max_ratio)]
    if not found:
        return docs.select(*columns, F.array().cast(MATCHES.format(id=id_type)).alias(into))
    parts = [f"__leaks{k}" for k in range(len(found))]
    out = docs.select(*columns, *(c.alias(n) for c, n in zip(found, parts)))
    return out.select(*columns, F.concat(*parts).alias(into))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 max_ratio: float = MAX_RATIO) -> DataFrame:
    """One row per (document, leaked item)."""
    found = with_matches(docs.select(F.col(id_col), F.col("text")), benchmark, max_ratio=max_ratio)
    return found.select(id_col, F.explode("leaks").alias("m")).select(id_col, "m.*")
