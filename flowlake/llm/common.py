"""Helpers shared by the operators: written tables, text hashing, worker state."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.session import scratch_path

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: later jobs read the files, and a lost executor costs
    only its running tasks.  The folder hangs below ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only.  Plain ``lower`` is the same for ASCII text and much
    faster; other text goes through ``translate``."""
    return (F.when(F.octet_length(col) == F.char_length(col), F.lower(col))
            .otherwise(F.translate(col, _UPPER, _UPPER.lower())))


def worker_state(name: str, build):
    """A value kept in a Python worker (models, word caches).  Workers serve one operator after
    another, so only the last value asked for is kept: a new one frees the one before."""
    home = sys.modules.setdefault("_flowlake_worker_state",
                                  types.ModuleType("_flowlake_worker_state"))
    if getattr(home, "name", None) != name:
        home.name, home.value = None, None
        home.name, home.value = name, build()
    return home.value


def sorted_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of rows that arrive sorted by ``keys``; one group is held at a time."""
    held: list[pd.DataFrame] = []
    key = None
    for batch in batches:
        for k, part in batch.groupby(keys, sort=False, dropna=False):
            if held and k != key:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            key = k
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


# --- vectorised word hashing ------------------------------------------------

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_K = np.uint64(0xD6E8FEB86659FD93)
_CHUNK = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_P), -1, 1 << 64))
    up = np.empty(n, np.uint64)
    down = np.empty(n, np.uint64)
    up[0] = down[0] = 1
    up[1:], down[1:] = _P, inverse
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


BLANK_BYTES = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
#: All but ASCII letters and digits and the bytes of other characters.
PUNCTUATION_BYTES = ~np.array([chr(b).isalnum() or b > 127 for b in range(256)])


def word_hashes(texts: list[bytes], gaps: np.ndarray = BLANK_BYTES) -> list[np.ndarray]:
    """For each text, one 64-bit hash per word; words are runs of bytes outside
    ``gaps`` (space and 0x09-0x0D).  Texts are hashed about a quarter of a megabyte at a time."""
    out: list[np.ndarray] = []
    group: list[bytes] = []
    size = 0
    for t in texts:
        group.append(t)
        size += len(t) + 1
        if size >= _CHUNK:
            out += _hash_group(group, gaps)
            group, size = [], 0
    if group:
        out += _hash_group(group, gaps)
    return out


def _hash_group(group: list[bytes], gaps: np.ndarray) -> list[np.ndarray]:
    buf = np.frombuffer(b"\n".join(group) + b"\n", np.uint8)
    n = len(buf)
    up, down = worker_state("powers", lambda: _powers(2 * _CHUNK)) if n < 2 * _CHUNK else _powers(n + 1)
    gap = gaps[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap)).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    total = np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64)
    before = np.where(starts > 0, total[starts - 1], np.uint64(0))
    words = mix((total[ends - 1] - before) * down[starts])
    bounds = np.cumsum([len(t) + 1 for t in group])
    cut = np.searchsorted(starts, bounds)
    return np.split(words, cut[:-1])


def ordered_hash(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words (order matters)."""
    n = len(words) - width + 1
    acc = words[:n].copy()
    for k in range(1, width):
        acc = acc * _K + words[k:k + n]
    return mix(acc)


def sequence_hash(words: np.ndarray) -> np.uint64:
    """Hash of a whole word sequence; differs from every ``ordered_hash``."""
    acc = np.array([0x5851F42D4C957F2D + len(words)], np.uint64)
    for w in words:
        acc = mix(acc * _K + w)
    return acc[0]
