"""URL filters: every glob rule simulated at once by a multiword Shift-And automaton.

A canonical URL is ``.`` + host (A-Z lower-cased), a separator symbol that no
text can hold, and the path.  Rules are globs over that string: ``*`` is any
run, ``?`` any one byte; neither crosses the separator.  State ``i`` of a
rule means "its first i symbols are matched"; all states of all rules are bits
of a row of 64-bit words.  One byte of input moves every rule of every URL of a
batch by one shift, one mask and one or.

Null url or no ``://``: host and path empty.  Empty path matches no rule with a
path.  Repeated rows each get their own answer; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEPARATOR = 256
STATE_BYTES = 1 << 24
_HOST_PATH = re.compile(r"([^/?#]*)([^?#]*)")


@dataclass(frozen=True)
class Rule:
    """``name`` is reported, ``verdict`` applies where ``host``/``path`` globs fit."""
    verdict: str
    name: str
    host: str
    path: str


def domain_rule(verdict: str, text: str) -> Rule:
    """``example.org/es/``: the host and its subdomains, paths that start so.
    Glob characters of the text are taken literally."""
    host, slash, path = text.partition("/")
    quote = lambda s: re.sub(r"([*?\\])", r"\\\1", s)
    return Rule(verdict, text, "*." + quote(host), quote(slash + path) + "*")


def canonical(url: str | None) -> tuple[str, str]:
    if url is None:
        return "", ""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    host, path = _HOST_PATH.match(rest).groups()
    return host.encode().lower().decode(), path


def _symbols(glob: str) -> list[int | str]:
    out: list[int | str] = []
    for m in re.finditer(r"\\(.)|([*?])|(.)", glob, re.S):
        literal, wild, plain = m.groups()
        if wild:
            out.append(wild)
        else:
            out += list((literal if literal is not None else plain).encode())
    return out


class ShiftAnd:
    """The packed automaton of many rules."""

    def __init__(self, rules: Iterable[Rule]):
        self.rules = list(rules)
        bit = 0
        first, last, step, stay = [], [], [], []
        for r in self.rules:
            first.append(bit)
            for s in [*_symbols(r.host), SEPARATOR, *_symbols(r.path)]:
                if s == "*":
                    stay.append(bit)
                else:
                    step.append((bit, s))
                    bit += 1
            last.append(bit)
            bit += 1
        self.words = max(1, -(-bit // 64))
        self.advance = np.zeros((257, self.words), np.uint64)
        self.loop = np.zeros((257, self.words), np.uint64)
        for b, s in step:
            rows = slice(0, 256) if s == "?" else s
            self.advance[rows, b // 64] |= np.uint64(1 << b % 64)
        for b in stay:
            self.loop[:256, b // 64] |= np.uint64(1 << b % 64)
        self.start = self._mask(first)
        self.final = last
        # states that no further byte of a path can change
        self.settled = self._mask([b for b in last if b in set(stay)])

    def _mask(self, bits: list[int]) -> np.ndarray:
        m = np.zeros(self.words, np.uint64)
        for b in bits:
            m[b // 64] |= np.uint64(1 << b % 64)
        return m

    def run(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """Final state words, one row per URL."""
        sep = np.array([SEPARATOR], np.uint16)
        parts, lengths = [], np.empty(len(hosts), np.int64)
        for k, (h, p) in enumerate(zip(hosts, paths)):
            h, p = b"." + h.encode(), p.encode()
            parts += [np.frombuffer(h, np.uint8).astype(np.uint16), sep,
                      np.frombuffer(p, np.uint8).astype(np.uint16)]
            lengths[k] = len(h) + 1 + len(p)
        state = np.repeat(self.start[None], len(hosts), 0)
        if not parts:
            return state
        flat = np.concatenate(parts)
        offset = np.cumsum(lengths) - lengths
        live, t = np.arange(len(hosts)), 0
        while len(live):
            d, c = state[live], flat[offset[live] + t]
            moved = d & self.advance[c]
            shifted = moved << np.uint64(1)
            shifted[:, 1:] |= moved[:, :-1] >> np.uint64(63)
            d = shifted | (d & self.loop[c])
            state[live] = d
            t += 1
            open_ = (d & ~self.settled).any(1)
            live = live[open_ & (t < lengths[live])]
        return state

    def best(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """Index of the longest fitting rule (the first listed of equal length), or -1."""
        state = self.run(hosts, paths)
        out = np.full(len(hosts), -1)
        order = sorted(range(len(self.rules)), key=lambda i: (len(self.rules[i].name), -i))
        for i in order:
            b = self.final[i]
            out[(state[:, b // 64] >> np.uint64(b % 64)) & np.uint64(1) == 1] = i
        return out

    def best_in_slices(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """``best`` of slices of the URLs, whose states take STATE_BYTES at most, however many the rules."""
        some = max(1, STATE_BYTES // (8 * self.words))
        found = [self.best(hosts[k:k + some], paths[k:k + some]) for k in range(0, len(hosts), some)]
        return np.concatenate(found) if found else np.empty(0, np.int64)


def judge_urls(df: DataFrame, rules: list[Rule], url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (null without one) and ``verdict``;
    columns of these names in ``df`` are replaced.  No rule fits: ``default``."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = ShiftAnd(rules)
        names = [r.name for r in rules] + [None]
        verdicts = [r.verdict for r in rules] + [default]
        for urls in batches:
            pairs = [canonical(u) for u in urls]
            hosts, paths = [h for h, _ in pairs], [p for _, p in pairs]
            best = automaton.best_in_slices(hosts, paths)
            yield pd.DataFrame({"host": hosts, "path": paths,
                                "rule": [names[i] for i in best],
                                "verdict": [verdicts[i] for i in best]})

    judged = F.pandas_udf(run, "host string, path string, rule string, verdict string")
    keep = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    out = df.select(*keep, judged(F.col(url_col)).alias("__judged"))
    return out.select(*keep, *(F.col(f"__judged.{c}").alias(c)
                               for c in ("host", "path", "rule", "verdict")))

