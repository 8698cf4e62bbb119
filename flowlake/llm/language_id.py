"""Language identification by a small byte convolutional network, in numpy.

A text's UTF-8 bytes are cut into fixed-length windows that cover all of it.
Filters of several widths run over each window (a filter is a table of weights
per offset and byte value, so applying it is a sum of look-ups), their maxima over
the window go through a softmax layer, and a text's answer is the mean of its
windows' probabilities, weighted by their bytes.

Training: ``fit`` draws at most ``per_label`` documents of each label (by a hash of
id and text, so the draw is uniform and repeatable; equal rows count once) and from each at most
``windows_per_doc`` windows at hashed places.  That sample is the only thing that
reaches the driver; its bound does not depend on the corpus.

Null text or text without a letter: ``und``, score 0.  No labelled row: every
text is ``und``.  Rows with a null label are never learned from.  Of labels that are equally
likely the first in order is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8


@dataclass
class ByteCNN:
    labels: list[str]
    tables: list[np.ndarray]      # per width: (width, 256, FILTERS)
    bias: np.ndarray              # (len(WIDTHS) * FILTERS,)
    dense: np.ndarray             # (len(WIDTHS) * FILTERS, labels)
    offset: np.ndarray            # (labels,)

    # --- use ---

    def pairs(self) -> list[list[np.ndarray]]:
        """Filters as sums over byte pairs (and one single byte for odd widths)."""
        out = []
        for t in self.tables:
            terms = []
            for k in range(0, len(t) - 1, 2):
                terms.append((t[k][:, None, :] + t[k + 1][None, :, :]).reshape(65536, -1))
            if len(t) % 2:
                terms.append(t[-1])
            out.append([np.ascontiguousarray(x, np.float32) for x in terms])
        return out

    def features(self, windows: np.ndarray, pairs: list[list[np.ndarray]]) -> np.ndarray:
        """Max-pooled filter outputs of (n, WINDOW) byte windows."""
        two = windows[:, :-1].astype(np.int32) * 256 + windows[:, 1:]
        out = []
        for width, terms in zip(WIDTHS, pairs):
            n = windows.shape[1] - width + 1
            y = None
            for k, table in enumerate(terms):
                source = two if len(table) == 65536 else windows
                part = table.take(source[:, 2 * k:2 * k + n].ravel(), axis=0)
                y = part if y is None else np.add(y, part, out=y)
            out.append(y.reshape(len(windows), n, -1).max(1))
        return np.maximum(np.concatenate(out, 1) + self.bias, 0)

    def probabilities(self, windows: np.ndarray, pairs: list[list[np.ndarray]], block: int = 512) -> np.ndarray:
        parts = [self.features(windows[i:i + block], pairs) @ self.dense + self.offset
                 for i in range(0, len(windows), block)]
        return softmax(np.concatenate(parts)) if parts else np.zeros((0, len(self.labels)))

    def predict(self, texts: list[bytes], pairs: list[list[np.ndarray]]) -> np.ndarray:
        """Mean window probabilities, one row per non-empty text."""
        windows, owner, weight = cut_windows(texts)
        p = self.probabilities(windows, pairs) * weight[:, None]
        total = np.zeros((len(texts), len(self.labels)))
        np.add.at(total, owner, p)
        return total / np.maximum(total.sum(1, keepdims=True), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def cut_windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over whole texts (the last one zero-padded), their text's index
    and their length in bytes."""
    sizes = np.array([len(t) for t in texts], np.int64)
    n = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(texts)), n)
    buf = b"".join(t + bytes(-len(t) % WINDOW) for t in texts)
    windows = np.frombuffer(buf, np.uint8).reshape(-1, WINDOW)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    return windows, owner, np.minimum(sizes[owner] - nth * WINDOW, WINDOW).astype(np.float64)


# --- training ----------------------------------------------------------------

def train(samples: list[tuple[str, bytes]], epochs: int = 6, batch: int = 64,
          rate: float = 0.01, seed: int = 0) -> ByteCNN | None:
    """Fit on (label, bytes) windows; short copies of windows are added so that
    short texts are covered too.  Adam on the softmax loss; max pooling sends the
    gradient to the winning place only."""
    labels = sorted({lab for lab, _ in samples})
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    rows, ys = [], []
    for lab, raw in samples:
        raw = raw[:WINDOW]
        for size in (len(raw), int(rng.integers(12, WINDOW))):
            rows.append(np.frombuffer(raw[:size] + bytes(WINDOW - min(size, len(raw))), np.uint8))
            ys.append(labels.index(lab))
    x, y = np.stack(rows), np.array(ys)
    model = ByteCNN(labels,
                    [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
                    np.zeros(len(WIDTHS) * FILTERS), rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(labels))),
                    np.zeros(len(labels)))
    share = np.bincount(y, minlength=len(labels)) / len(y)
    weight = (1 / np.maximum(share, 1e-9))[y]
    weight /= weight.mean()
    params = [*model.tables, model.bias, model.dense, model.offset]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            pick = order[at:at + batch]
            xb, yb = x[pick], y[pick]
            pooled, where = [], []
            for w, table in zip(WIDTHS, model.tables):
                n = WINDOW - w + 1
                z = sum(table[k][xb[:, k:k + n]] for k in range(w))
                top = z.argmax(1)
                where.append(top)
                pooled.append(np.take_along_axis(z, top[:, None, :], 1)[:, 0])
            pre = np.concatenate(pooled, 1) + model.bias
            h = np.maximum(pre, 0)
            p = softmax(h @ model.dense + model.offset)
            p[np.arange(len(pick)), yb] -= 1
            p *= weight[pick][:, None] / len(pick)
            back = (p @ model.dense.T) * (pre > 0)
            grads = []
            for i, w in enumerate(WIDTHS):
                g = np.zeros_like(model.tables[i])
                part = back[:, i * FILTERS:(i + 1) * FILTERS]
                for k in range(w):
                    byte = np.take_along_axis(xb, where[i] + k, 1)
                    np.add.at(g[k], (byte, np.arange(FILTERS)[None]), part)
                grads.append(g)
            grads += [back.sum(0), h.T @ p, p.sum(0)]
            step += 1
            for q, g, mi, vi in zip(params, grads, m, v):
                mi += 0.1 * (g - mi)
                vi += 0.001 * (g * g - vi)
                q -= rate * (mi / (1 - 0.9 ** step)) / (np.sqrt(vi / (1 - 0.999 ** step)) + 1e-8)
    return model


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
        per_label: int = 800, windows_per_doc: int = 3) -> ByteCNN | None:
    """Train on a bounded sample: at most ``per_label`` different documents of each label and
    ``windows_per_doc`` windows of each."""
    known = labelled.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull()
                            & (F.col(text_col) != ""))
    counts = {r["l"]: r["n"] for r in known.groupBy(F.col(label_col).alias("l"))
              .agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    # drawn by id and text, equal rows once: neither an id nor a text that many rows share is drawn whole
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    draw = F.pmod(key, F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for lab, n in counts.items():
        share = F.when(F.col(label_col) == lab, F.lit(min(1.0, per_label / n))).otherwise(share)
    chars = F.char_length(F.col(text_col))
    places = [F.substring(F.col(text_col), F.pmod(F.xxhash64(F.col(id_col), F.lit(k)),
                                                  F.greatest(chars - WINDOW, F.lit(1))).cast("int") + 1,
                          F.lit(WINDOW)) for k in range(windows_per_doc)]
    drawn = (known.filter(draw < share).groupBy(F.col(label_col).alias("l"), key.alias("k"))
             .agg(F.min(F.array(*places)).alias("w")))
    rank = F.row_number().over(Window.partitionBy("l").orderBy("k"))
    rows = drawn.withColumn("r", rank).filter(F.col("r") <= per_label).select("l", "w").collect()
    # in a fixed order, so that the same table gives the same model
    return train(sorted((r["l"], w.encode()) for r in rows for w in r["w"] if w))


_LETTER = regex.compile(r"\p{L}")


def language_of(model: ByteCNN | None):
    """Column function: text -> struct(lang string, score double)."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pairs = model.pairs() if model else []
        for texts in batches:
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if model else []
            values = texts.tolist()
            for at in range(0, len(known), 256):
                some = known[at:at + 256]
                p = model.predict([values[i].encode() for i in some], pairs)
                for i, row in zip(some, p):
                    lang[i], score[i] = model.labels[int(row.argmax())], float(row.max())
            yield pd.DataFrame({"lang": lang, "score": np.clip(score, 0, 1)})

    return F.pandas_udf(run, "lang string, score double")


def identify(docs: DataFrame, model: ByteCNN | None, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``; columns of these names are replaced."""
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return (docs.select(*columns, language_of(model)(F.col(text_col)).alias("__lang"))
            .select(*columns, F.col("__lang.lang").alias("lang_pred"), F.col("__lang.score").alias("score")))


def training_rows(id_col: str = "doc_id") -> Column:
    """The fixed split: crc32 of the id as text, mod 4, is not 2 (null ids: not trained on)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != 2, F.lit(False))
