"""Language-model scores by context-tree weighting over bytes.

A text is its lower-cased (A-Z) words joined by single spaces, then an end byte that no
UTF-8 text holds.  A byte is eight binary decisions; each decision (the bits of the byte so far)
has a context tree over the bytes before it, nearest first, ``depth`` levels deep.  A node counts
the zeros and ones seen after its context, ``Pe`` is their Krichevsky-Trofimov probability,
and a node weighs "stop here" against "look one byte further back":

    Pw = Pe at the deepest level, else (Pe + product of the children's Pw) / 2

A bit is predicted by the mixture along its context's path, each node with the weight
``Pe / (2 Pw)`` that training gave it: all depths take part, in proportion to how well they
explain the training texts.  Counts stay as trained while texts are scored.

The statistics cover every training text, and all of it runs on Spark:

1. Texts are read once, in chunks of about ``CHUNK_BYTES``.  A chunk sends its distinct
   (context, byte) grams and its distinct words with their training counts, dealt by
   the two nearest context bytes and by the word, and its texts, to a written table.
2. Each bucket merges its counts as a sorted stream.  A bucket holds whole subtrees below
   two context bytes, so their Pw is known there; only the sums for the at most 65,280 nodes
   above (no or one byte of context) reach the driver and go back with the tasks.
3. Each bucket answers the chunks: the log probability of each gram (single precision: an
   error of about 1e-7 of its size), the count of each word.
4. Each chunk adds up its texts' bytes and words.

What is sent thus grows with the texts, no task holds more than a bucket's distinct grams or words
or one chunk, and no group is formed by a document's content.  ``buckets`` follows the
session's shuffle partitions; raise it with the vocabulary.

Beside it the base score: add-one word probabilities of the training words, the end included.

Null texts are empty (the end alone).  Rows are scored one by one: repeated rows and ids
count each time, null ids are kept.  ``trained`` that is null counts as false.  Without training rows
every bit has probability 1/2 and the base score is 0.  An empty table gives no rows.  Of
other columns none is read or returned.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import written

DEPTH = 5
#: Bytes of text in a chunk (one text at least).
CHUNK_BYTES = 16 << 20
#: Bytes of text whose grams are looked at at once.
WINDOW_BYTES = 1 << 19
#: Grams of a bucket whose trees are built at once (whole subtrees).
SLICE_GRAMS = 1 << 17
#: Rows of an Arrow batch that become Python objects at once, and that are sent at once.
BATCH_ROWS = 64
START, END = 0xFE, 0xFF      # no byte of a UTF-8 text
_HALF = np.log(0.5)

TEXTS, GRAMS, WORDS, NODES = 0, 1, 2, 3
_CHUNKS = ("chunk long, kind int, bucket int, id {id}, trained boolean, spelled binary, tokens long, "
           "keys binary, counts binary")
_MODEL = "kind int, bucket int, keys binary, counts binary, node int, zeros long, ones long, log_pw double, known long"
_ANSWERS = "chunk long, kind int, bucket int, keys binary, counts binary"
_SCORES = "id {id}, trained boolean, n_tokens long, n_known long, n_bytes long, base double, score double"


# --- grams ---------------------------------------------------------------------

def spelled_words(text: bytes | None) -> list[bytes]:
    """Words outside space and 0x09-0x0D, A-Z lower-cased (``bytes`` methods do just this)."""
    return (text or b"").lower().split()


def _symbols(texts: list[bytes], depth: int) -> np.ndarray:
    lead = bytes([START]) * depth
    return np.frombuffer(b"".join(lead + t + bytes([END]) for t in texts), np.uint8)


def gram_keys(symbols: np.ndarray, depth: int) -> np.ndarray:
    """For each byte but the leads: the ``depth`` bytes before it, nearest first, then the
    byte itself, as one number."""
    n = len(symbols) - depth
    key = np.zeros(n, np.uint64)
    for j in range(1, depth + 1):
        key = key << np.uint64(8) | symbols[depth - j:depth - j + n]
    key = key << np.uint64(8) | symbols[depth:]
    return key[symbols[depth:] != START]


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys with their summed counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


class Tally:
    """Gram counts, merged as they come."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.loose = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.loose += len(keys)
        if self.loose > len(self.parts[0][0]) + (1 << 18):
            self.parts = [self.total()]
            self.loose = 0

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return merged(*(np.concatenate(x) for x in zip(*self.parts)))


def planes(values: np.ndarray) -> bytes:
    """Whole numbers as all their lowest bytes, then all next ones, ...: what is zero packs well."""
    return values.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def packed(keys: np.ndarray) -> bytes:
    """Ascending keys as steps."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data).view(np.uint64), dtype=np.uint64)


def windows(texts: list[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= WINDOW_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def tally_texts(tally: Tally, texts: list[bytes], trained: bool, depth: int) -> None:
    for some in windows(texts):
        symbols = _symbols(some, depth)
        for at in range(0, len(symbols) - depth, WINDOW_BYTES * 2):      # a very long text in parts
            keys, n = np.unique(gram_keys(symbols[at:at + WINDOW_BYTES * 2 + depth], depth), return_counts=True)
            tally.add(keys, n if trained else np.zeros(len(n), np.int64))


def bucket_of(keys: np.ndarray, depth: int, buckets: int) -> np.ndarray:
    """By the two nearest bytes of context, so that a bucket holds whole subtrees."""
    near = keys >> np.uint64(8 * (depth - 1))
    return ((near * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(buckets)


# --- trees ---------------------------------------------------------------------

def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln gamma of positive numbers (Stirling's series above 7)."""
    z, below = np.array(x, np.float64), np.ones(np.shape(x))
    for _ in range(7):
        small = z < 7
        below = np.where(small, below * z, below)
        z = np.where(small, z + 1, z)
    r = 1 / (z * z)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r * (1 / 1188 - r * 691 / 360360))))) / z
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - np.log(below)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of that many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - np.log(np.pi) - log_gamma(zeros + ones + 1.0)


def _weighted(log_pe: np.ndarray, children: np.ndarray) -> np.ndarray:
    return _HALF + np.logaddexp(log_pe, children)


class Forest:
    """The trees of whole subtrees below two bytes of context: grams ascending, with counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int):
        self.depth = depth
        self.keys = {depth: keys}
        self.counts = {depth: counts}
        self.place = {depth: np.arange(len(keys))}           # of each gram in each level's grams
        for d in range(depth - 1, 1, -1):
            deep = self.keys[d + 1]
            short = (deep >> np.uint64(16)) << np.uint64(8) | deep & np.uint64(255)
            level, back = np.unique(short, return_inverse=True)
            total = np.zeros(len(level), np.int64)
            np.add.at(total, back, self.counts[d + 1])
            self.keys[d], self.counts[d], self.place[d] = level, total, back[self.place[d + 1]]

    def level(self, d: int, bit: int):
        """Nodes of a level for one decision: node of each of its grams, first grams, zeros, ones."""
        keys, counts = self.keys[d], self.counts[d]
        ids = keys >> np.uint64(8 - bit)
        new = np.concatenate(([True], ids[1:] != ids[:-1]))
        first = np.flatnonzero(new)
        total = np.add.reduceat(counts, first)
        ones = np.add.reduceat(counts * ((keys >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int64), first)
        return np.cumsum(new) - 1, first, total - ones, ones

    def decisions(self) -> Iterator[tuple[int, dict]]:
        """For each of the eight decisions, per level: (node of each gram, first, zeros, ones, ln Pw, weight)."""
        for bit in range(8):
            levels: dict[int, tuple] = {}
            for d in range(self.depth, 1, -1):
                node, first, zeros, ones = self.level(d, bit)
                log_pe = log_kt(zeros, ones)
                if d == self.depth:
                    log_pw, weight = log_pe, np.ones(len(log_pe))
                else:
                    below_first, below = levels[d + 1][1], levels[d + 1][4]
                    deep = self.keys[d + 1][below_first]
                    short = (deep >> np.uint64(16)) << np.uint64(8) | deep & np.uint64(255)
                    parent = node[np.searchsorted(self.keys[d], short)]
                    log_pw = _weighted(log_pe, np.bincount(parent, below, len(first)))
                    weight = np.exp(_HALF + log_pe - log_pw)
                levels[d] = (node, first, zeros, ones, log_pw, weight)
            yield bit, levels

    def above(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What the nodes with one byte of context get from here: node id, zeros, ones, sum of ln Pw.
        A node id is the byte, then the bits so far behind a leading one."""
        out = []
        for bit, levels in self.decisions():
            _, first, zeros, ones, log_pw, _ = levels[2]
            key = self.keys[2][first]
            out.append((_node_id(key, key >> np.uint64(16), bit), zeros, ones, log_pw))
        ids, zeros, ones, log_pw = (np.concatenate(x) for x in zip(*out))
        node, back = np.unique(ids, return_inverse=True)
        sums = [np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)]
        np.add.at(sums[0], back, zeros)
        np.add.at(sums[1], back, ones)
        return node, *sums, np.bincount(back, log_pw, len(node))

    def log_probability(self, top: "Top") -> np.ndarray:
        """log10 of each gram's byte after its context."""
        keys = self.keys[self.depth]
        out = np.zeros(len(keys))
        near = keys >> np.uint64(8 * self.depth)
        for bit, levels in self.decisions():
            one = ((keys >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
            p = np.full(len(keys), 0.5)
            for d in range(self.depth, 1, -1):
                node, _, zeros, ones, _, weight = levels[d]
                at = node[self.place[d]]
                p = _mixed(weight[at], zeros[at], ones[at], one, p)
            ids = _node_id(keys, near, bit)
            p = _mixed(top.weight1[ids], top.zeros1[ids], top.ones1[ids], one, p)
            ids = ids & 255
            p = _mixed(top.weight0[ids], top.zeros0[ids], top.ones0[ids], one, p)
            out += np.log10(p)
        return out


def _node_id(keys: np.ndarray, near: np.ndarray, bit: int) -> np.ndarray:
    prefix = (keys & np.uint64(255)) >> np.uint64(8 - bit)
    return ((near & np.uint64(255)) << np.uint64(8) | np.uint64(1 << bit) | prefix).astype(np.int64)


def _mixed(weight, zeros, ones, one, deeper) -> np.ndarray:
    here = (np.where(one, ones, zeros) + 0.5) / (zeros + ones + 1.0)
    return weight * here + (1 - weight) * deeper


class Top:
    """Nodes with one byte of context (256 x 255) and with none (255): fixed in size."""

    def __init__(self, nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray):
        size = 1 << 16
        self.zeros1, self.ones1 = np.zeros(size, np.int64), np.zeros(size, np.int64)
        below = np.zeros(size)
        self.zeros1[nodes], self.ones1[nodes], below[nodes] = zeros, ones, children
        log_pe = log_kt(self.zeros1, self.ones1)
        log_pw = _weighted(log_pe, below)
        self.weight1 = np.exp(_HALF + log_pe - log_pw)
        self.zeros0, self.ones0 = self.zeros1.reshape(256, 256).sum(0), self.ones1.reshape(256, 256).sum(0)
        log_pe = log_kt(self.zeros0, self.ones0)
        self.weight0 = np.exp(_HALF + log_pe - _weighted(log_pe, log_pw.reshape(256, 256).sum(0)))


def subtree_slices(keys: np.ndarray, depth: int) -> Iterator[slice]:
    """Parts of ascending grams that hold whole subtrees below two bytes of context."""
    at = 0
    while at < len(keys):
        end = at + SLICE_GRAMS
        if end < len(keys):
            shift = np.uint64(8 * (depth - 1))
            end = int(np.searchsorted(keys, ((keys[end - 1] >> shift) + np.uint64(1)) << shift))
        yield slice(at, end)
        at = end


# --- the passes ------------------------------------------------------------------

def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _arrow(*fields: tuple[str, pa.DataType]) -> pa.Schema:
    return pa.schema(list(fields))


_BIN, _INT, _LONG = pa.binary(), pa.int32(), pa.int64()
_MODEL_ARROW = _arrow(("kind", _INT), ("bucket", _INT), ("keys", _BIN), ("counts", _BIN), ("node", _INT),
                      ("zeros", _LONG), ("ones", _LONG), ("log_pw", pa.float64()), ("known", _LONG))
_ANSWER_ARROW = _arrow(("chunk", _LONG), ("kind", _INT), ("bucket", _INT), ("keys", _BIN), ("counts", _BIN))


def chunked(docs: DataFrame, depth: int, buckets: int) -> DataFrame:
    """``id, trained, text`` as chunks: a row per text, and per chunk and bucket the distinct
    grams and words with their training counts."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        chunk = (context.partitionId() if context else 0) << 32
        texts: dict[bool, list[bytes]] = {True: [], False: []}
        words: Counter = Counter()           # of training texts
        others: set[bytes] = set()           # words of other texts
        size, schema = 0, None

        def closed() -> Iterator[pa.RecordBatch]:
            tally = Tally()
            for trained, some in texts.items():
                tally_texts(tally, some, trained, depth)
                some.clear()
            keys, counts = tally.total()
            where = bucket_of(keys, depth, buckets)
            for b in np.unique(where):
                mine = where == b
                yield _rows([(chunk, GRAMS, int(b), None, None, None, None, packed(keys[mine]),
                              planes(counts[mine]))], schema)
            others.difference_update(words)
            dealt: list[list[bytes]] = [[] for _ in range(buckets)]
            for w in words:
                dealt[zlib.crc32(w) % buckets].append(w)
            for w in others:
                dealt[zlib.crc32(w) % buckets].append(w)
            others.clear()
            for b, some in enumerate(dealt):
                if some:
                    n = np.fromiter((words.get(w, 0) for w in some), np.int64, len(some))
                    yield _rows([(chunk, WORDS, b, None, None, None, None, b" ".join(some), planes(n))], schema)
            words.clear()

        for batch in batches:
            if schema is None:
                schema = _arrow(("chunk", _LONG), ("kind", _INT), ("bucket", _INT),
                                ("id", batch.schema.field("id").type), ("trained", pa.bool_()), ("spelled", _BIN),
                                ("tokens", _LONG), ("keys", _BIN), ("counts", _BIN))
            rows = []
            for key, trained, text in _groups([batch], "id", "trained", "text"):
                mine = spelled_words(text)
                line = b" ".join(mine)
                if trained:
                    words.update(mine)
                else:
                    others.update(mine)
                texts[trained].append(line)
                rows.append((chunk, TEXTS, -1, key, trained, line, len(mine) + 1, None, None))
                size += len(line) + 1
                if len(rows) == BATCH_ROWS or size >= CHUNK_BYTES:
                    yield _rows(rows, schema)
                    rows = []
                if size >= CHUNK_BYTES:
                    yield from closed()
                    size, chunk = 0, chunk + 1
            if rows:
                yield _rows(rows, schema)
        if size:
            yield from closed()

    return docs.mapInArrow(run, _CHUNKS.format(id=id_type))


def _groups(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows as tuples; only ``BATCH_ROWS`` of a batch are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(at, BATCH_ROWS)
            yield from zip(*(part.column(n).to_pylist() for n in names))


def bucket_model(requests: DataFrame, depth: int) -> DataFrame:
    """Merged counts of each bucket, and what its trees pass to the nodes above."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tally, words = None, Tally(), Counter()

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal tally
            kind, bucket = now
            if kind == GRAMS:
                keys, counts = tally.total()
                for part in subtree_slices(keys, depth):
                    k, c = keys[part], counts[part]
                    yield _rows([(kind, bucket, packed(k), planes(c), None, None, None, None, None)], _MODEL_ARROW)
                    nodes = Forest(k, c, depth).above()
                    yield _rows([(NODES, bucket, None, None, *(v.item() for v in row), None) for row in zip(*nodes)],
                                _MODEL_ARROW)
                tally = Tally()
            else:
                known = [w for w in words.items() if w[1]]
                n = np.fromiter((c for _, c in known), np.int64, len(known))
                yield _rows([(kind, bucket, b" ".join(w for w, _ in known), planes(n), None, None, None, None,
                              len(known))], _MODEL_ARROW)
                words.clear()

        for kind, bucket, keys, counts in _groups(batches, "kind", "bucket", "keys", "counts"):
            if now != (kind, bucket):
                if now is not None:
                    yield from closed()
                now = (kind, bucket)
            if kind == GRAMS:
                tally.add(unpacked(keys), from_planes(counts))
            else:
                for w, n in zip(keys.split(b" "), from_planes(counts).tolist()):
                    words[w] += n
        if now is not None:
            yield from closed()

    rows = requests.select("kind", "bucket", "keys", "counts").repartition("kind", "bucket")
    return rows.sortWithinPartitions("kind", "bucket").mapInArrow(run, _MODEL)


def answers(model: DataFrame, requests: DataFrame, top: Top, depth: int) -> DataFrame:
    """For each chunk and bucket the log10 probability of its grams, the count of its words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, table, words = None, [], None, {}
        for kind, bucket, chunk, keys, counts in _groups(batches, "kind", "bucket", "chunk", "keys", "counts"):
            if now != (kind, bucket):
                now, parts, table, words = (kind, bucket), [], None, {}
            if chunk is None and kind == GRAMS:
                k = unpacked(keys)
                parts.append((k, Forest(k, from_planes(counts), depth).log_probability(top).astype(np.float32)))
            elif chunk is None:
                words = dict(zip(keys.split(b" "), from_planes(counts).tolist()))
            elif kind == GRAMS:
                if table is None:
                    parts.sort(key=lambda p: p[0][0])
                    table = [np.concatenate(x) for x in zip(*parts)]
                    parts = []
                value = table[1][np.searchsorted(table[0], unpacked(keys))]
                yield _rows([(chunk, kind, bucket, keys, value.tobytes())], _ANSWER_ARROW)
            else:
                asked = keys.split(b" ")
                n = np.fromiter((words.get(w, 0) for w in asked), np.int64, len(asked))
                yield _rows([(chunk, kind, bucket, keys, planes(n))], _ANSWER_ARROW)

    slices = model.filter(F.col("kind") != NODES).select(
        "kind", "bucket", F.lit(None).cast("long").alias("chunk"), "keys", "counts")
    both = slices.unionByName(requests.select("kind", "bucket", "chunk", "keys", "counts"))
    return (both.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket", F.asc_nulls_first("chunk"))
            .mapInArrow(run, _ANSWERS))


def _score_texts(texts: list[bytes], keys: np.ndarray, log_p: np.ndarray, depth: int) -> list[float]:
    out: list[float] = []
    for some in windows(texts):
        symbols = _symbols(some, depth)
        value = np.zeros(len(symbols))
        for at in range(0, len(symbols) - depth, WINDOW_BYTES * 2):
            part = symbols[at:at + WINDOW_BYTES * 2 + depth]
            spoken = part[depth:] != START
            value[at + depth:at + len(part)][spoken] = log_p[np.searchsorted(keys, gram_keys(part, depth))]
        ends = np.cumsum([depth + len(t) + 1 for t in some])
        out += np.add.reduceat(value, np.concatenate(([0], ends[:-1]))).tolist()
    return out


def chunk_scores(texts: DataFrame, answered: DataFrame, end_count: int, depth: int) -> DataFrame:
    id_type = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, lines, grams, words, schema = None, [], [], {}, None

        def closed() -> Iterator[pa.RecordBatch]:
            keys, log_p = (np.concatenate(x) for x in zip(*grams))
            grams.clear()
            order = np.argsort(keys)
            keys, log_p = keys[order], log_p[order]
            end = float(np.log10(end_count + 1))
            for at in range(0, len(lines), BATCH_ROWS):
                some = lines[at:at + BATCH_ROWS]
                rows = []
                for (key, trained, line, tokens), score in zip(some, _score_texts([t for _, _, t, _ in some], keys,
                                                                                  log_p, depth)):
                    spoken = line.split(b" ") if line else []
                    value = np.fromiter(map(words.__getitem__, spoken), np.float64, len(spoken))
                    rows.append((key, trained, tokens, int(np.count_nonzero(value)) + (end_count > 0), len(line) + 1,
                                 float(value.sum()) + end, score))
                yield _rows(rows, schema)

        names = ("chunk", "kind", "id", "trained", "spelled", "tokens", "keys", "counts")
        for batch in batches:
            if schema is None:
                schema = _arrow(("id", batch.schema.field("id").type), ("trained", pa.bool_()), ("n_tokens", _LONG),
                                ("n_known", _LONG), ("n_bytes", _LONG), ("base", pa.float64()), ("score", pa.float64()))
            for chunk, kind, key, trained, line, tokens, keys, counts in _groups([batch], *names):
                if now != chunk:
                    if now is not None:
                        yield from closed()
                    now, lines, grams, words = chunk, [], [], {}
                if kind == TEXTS:
                    lines.append((key, trained, line, tokens))
                elif kind == GRAMS:
                    grams.append((unpacked(keys), np.frombuffer(counts, np.float32)))
                else:
                    value = np.log10(from_planes(counts) + 1.0)
                    words.update(zip(keys.split(b" "), value.tolist()))
        if now is not None:
            yield from closed()

    both = (texts.select("chunk", "kind", "id", "trained", "spelled", "tokens")
            .unionByName(answered.select("chunk", "kind", "keys", "counts"), allowMissingColumns=True))
    return (both.repartition("chunk").sortWithinPartitions("chunk")
            .mapInArrow(run, _SCORES.format(id=id_type)))


# --- the operator ------------------------------------------------------------------

def score_documents(docs: DataFrame, trained: Column, id_col: str = "doc_id", text_col: str = "text",
                    depth: int = DEPTH, buckets: int | None = None) -> DataFrame:
    """Train on the rows where ``trained`` holds and score all rows:
    ``id, trained, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte``."""
    if not 2 <= depth <= 7:
        raise ValueError("a gram has 3 to 8 bytes: depth must be 2 to 7")
    spark = docs.sparkSession
    buckets = buckets or max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(trained, F.lit(False)).alias("trained"),
                       F.col(text_col).cast("binary").alias("text"))
    chunks = written(chunked(rows, depth, buckets), "ctw-chunks")
    texts = chunks.filter(F.col("kind") == TEXTS)
    requests = chunks.filter(F.col("kind") != TEXTS)
    model = written(bucket_model(requests, depth), "ctw-model")
    sums = (model.filter(F.col("kind") == NODES).groupBy("node")
            .agg(F.sum("zeros"), F.sum("ones"), F.sum("log_pw")).orderBy("node").collect())
    columns = [np.array(c) for c in zip(*sums)] or [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
    size = texts.filter("trained").agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
                                       F.count("*").alias("ends")).first()
    known = model.agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0] + (size["ends"] > 0)
    answered = answers(model, requests, Top(*columns), depth)
    scored = chunk_scores(texts, answered, size["ends"], depth)
    space = float(np.log10(size["tokens"] + known + 1))
    return scored.select(
        F.col("id").alias(id_col), "trained", "n_tokens", "n_known", F.lit(size["tokens"]).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(space)).alias("base_score"), "score", "n_bytes",
        (-F.col("score") * F.lit(float(np.log2(10))) / F.col("n_bytes")).alias("bits_per_byte"))
