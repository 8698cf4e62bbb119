"""Cheapest repair of damaged conversations.

A conversation's rows, by turn (nulls first; rows of one turn by role, then text),
are edited so that the initials of the roles read ``(s?(ua)+)?``: an optional system
row, then user and assistant in turns.  Keep is free, Rerole (to user or assistant)
costs 1, Delete 2, Insert of an empty user or assistant row 5.  Blank and duplicate rows must
go; a truncated row that stays costs 5 more.  Of the cheapest edits the ASCII-least string
of their initials wins (the audit).

Faults are found by Spark: equal rows are counted, a duplicate is a row whose role
and text stand at an earlier turn (partially aggregated minima joined back), or a further copy.

The search reads each conversation as a stream, in order, and keeps the best edits
for each of the four places in the grammar.  Edit strings are linked nodes that share their
prefixes; a node knows its 2^k-th ancestors and a rolling hash of its string.  Equal costs
are settled by the longest common prefix, found by halving steps over the
ancestors; a prefix that only the hash calls equal is compared letter by letter.
Two strings of equal cost at one place never extend each other (insertions cost),
so the comparison holds whatever follows.  Each of the four also carries the digest of its
repaired text, so no text is held.  As soon as all four share a prefix it is final and its
nodes are given up; what is held of a conversation, however long, is its audit and
the letters on which the four still differ.

One digest runs over a whole conversation, so one task reads it: a stream without a
buffer.

Null roles and texts are one space, null turns come first and count for no gap, a null
conversation id is a conversation of its own.  Rows that are alike in all but other columns are
copies of each other.  A conversation of which no row is left has zeros, an empty audit and the
digest of the empty string.  An empty table gives no rows.  Output names other than the
conversation's are fixed; other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
_BLANK = r"[\x20\x09-\x0D]"

#: Places in the grammar: nothing yet, after the system row, a user's or an assistant's turn done.
START, SYSTEM, USER, ASSISTANT = range(4)
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT,
         (ASSISTANT, "u"): USER}
#: Place -> role that a re-roled or inserted row gets there, and the place after it.
_SPOKEN = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

SUMMARY = ("__conv {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")


# --- persistent edit strings -------------------------------------------------

class Edits:
    """An edit string as a linked node: its last letter, the string before it, its 2^k-th
    ancestors and a rolling hash."""

    __slots__ = ("letter", "length", "hash", "up")
    BASE, MODULUS = 1_000_003, (1 << 61) - 1

    def __init__(self, before: "Edits | None" = None, letter: str = ""):
        self.letter = letter
        if before is None:
            self.length, self.hash, self.up = 0, 0, ()
            return
        self.length = before.length + 1
        self.hash = (before.hash * self.BASE + ord(letter)) % self.MODULUS
        up, k = [before], 0
        while k < len(up[k].up):
            up.append(up[k].up[k])
            k += 1
        self.up = up

    def ancestor(self, length: int) -> "Edits":
        node = self
        while node.length > length:
            node = node.up[min((node.length - length).bit_length(), len(node.up)) - 1]
        return node

    def letters(self, after: int = 0) -> str:
        """The string from position ``after`` on."""
        out, node = [], self
        while node.length > after:
            out.append(node.letter)
            node = node.up[0]
        return "".join(reversed(out))


def common_prefix(a: Edits, b: Edits) -> Edits:
    """The node of ``a`` that ends the longest common prefix of two strings."""
    size = min(a.length, b.length)
    a, b = a.ancestor(size), b.ancestor(size)
    if a is b:
        return a
    while a.hash != b.hash:
        for k in reversed(range(min(len(a.up), len(b.up)))):
            if a.up[k].hash != b.up[k].hash:
                a, b = a.up[k], b.up[k]
                break
        else:
            a, b = a.up[0], b.up[0]
            break
    # equal by hash: true if it is one node, else the letters decide
    found, x, y = a, a, b
    while x is not y and x.length:
        if x.letter != y.letter:
            found = x.up[0]
        if not x.up or not y.up:
            break
        x, y = x.up[0], y.up[0]
    return found


def smaller(a: Edits, b: Edits) -> bool:
    """Is the string of ``a`` ASCII-less than that of ``b``?"""
    size = common_prefix(a, b).length
    if size == a.length or size == b.length:
        return a.length < b.length
    return a.ancestor(size + 1).letter < b.ancestor(size + 1).letter


# --- the search --------------------------------------------------------------

class Path:
    """Cheapest edits that lead to a place: cost, edit string and digest of the repaired text."""

    __slots__ = ("cost", "edits", "digest")

    def __init__(self, cost: int, edits: Edits, digest):
        self.cost, self.edits, self.digest = cost, edits, digest


class Repair:
    """The search over one conversation, fed row by row."""

    #: Rows between two looks for a prefix that all paths share.
    SETTLE_ROWS = 256

    def __init__(self):
        self.settled: list[str] = []        # letters that are final
        self.root = 0                       # how many
        self.fed = 0
        self.paths: list[Path | None] = [Path(0, Edits(), None), None, None, None]
        self._insert()

    @staticmethod
    def _better(best, cost: int, before: Path, letter: str, role: str | None, text: str):
        """The better of two candidates ``(cost, path before, letter, role, text, node)``."""
        if best is None or cost < best[0]:
            return (cost, before, letter, role, text, None)
        if cost > best[0]:
            return best
        if before is best[1]:
            return (cost, before, letter, role, text, None) if letter < best[2] else best
        mine = Edits(before.edits, letter)
        other = best[5] or Edits(best[1].edits, best[2])
        if smaller(mine, other):
            return (cost, before, letter, role, text, mine)
        return (*best[:5], other)

    @staticmethod
    def _taken(found) -> Path:
        cost, before, letter, role, text, node = found
        digest = before.digest
        if role is not None:
            line = f"{role}:{text}".encode("utf-8", "surrogatepass")
            if digest is None:
                digest = hashlib.sha256(line)
            else:
                digest = digest.copy()
                digest.update(b"\n" + line)
        return Path(cost, node or Edits(before.edits, letter), digest)

    def _insert(self) -> None:
        for place in (USER, ASSISTANT):     # two in a row can only be user, assistant
            best = self.paths[place]
            found = None if best is None else (best.cost, None)
            new = None
            for before, path in enumerate(self.paths):
                if path is None or _SPOKEN[before][1] != place:
                    continue
                cost = path.cost + INSERT_COST
                if found is None or cost < found[0]:
                    new = self._better(new, cost, path, INSERT, _SPOKEN[before][0], "")
                elif cost == found[0]:
                    if smaller(Edits(path.edits, INSERT), best.edits):
                        new = self._better(new, cost, path, INSERT, _SPOKEN[before][0], "")
            if new is not None:
                self.paths[place] = self._taken(new)

    def add(self, role: str, text: str | None, must_go: bool, truncated: bool) -> None:
        found: list = [None] * 4
        initial = role[:1]
        for place, path in enumerate(self.paths):
            if path is None:
                continue
            found[place] = self._better(found[place], path.cost + DELETE_COST, path, DELETE, None, "")
            if must_go:
                continue
            stays = path.cost + (TRUNCATED_COST if truncated else 0)
            to = _KEPT.get((place, initial))
            if to is not None:
                found[to] = self._better(found[to], stays, path, KEEP, role, text)
            spoken, to = _SPOKEN[place]
            found[to] = self._better(found[to], stays + REROLE_COST, path, REROLE, spoken, text)
        self.paths = [None if f is None else self._taken(f) for f in found]
        self._insert()
        self.fed += 1
        if self.fed % self.SETTLE_ROWS == 0:
            self._settle()

    def _settle(self) -> None:
        """Letters that all paths share are final.  Paths that can't win any more don't hold them up."""
        done = self.paths[ASSISTANT]
        if done is not None:
            # whatever follows the start, or the system row, can follow the last assistant row
            # too, for one deletion more at most
            for place in (START, SYSTEM):
                path = self.paths[place]
                if path is not None and path.cost > done.cost + DELETE_COST:
                    self.paths[place] = None
        live = [p.edits for p in self.paths if p is not None]
        shared = live[0]
        for other in live[1:]:
            shared = common_prefix(shared, other)
        if shared.length > self.root:
            self.settled.append(shared.letters(self.root))
            self.root = shared.length
            shared.up = ()                  # older nodes are free once nothing points past it

    def result(self) -> tuple[int, str, str]:
        best = None
        for place in (START, ASSISTANT):
            path = self.paths[place]
            if path is not None and (best is None or path.cost < best.cost or
                                     path.cost == best.cost and smaller(path.edits, best.edits)):
                best = path
        digest = best.digest or hashlib.sha256()
        return best.cost, "".join(self.settled) + best.edits.letters(self.root), digest.hexdigest()


# --- rows --------------------------------------------------------------------

def damage(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", gone: str = "gone") -> DataFrame:
    """Rows damaged by ``crc32(conv:turn) % 20``: 0 drops the row (it stays as a row with
    ``gone`` set), 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 sets the role user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(conv_col), F.lit(":"), space(turn_col)).cast("binary")) % 20
    text = (F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(space(text_col), "[.!?]", ""))
            .otherwise(space(text_col)))
    return df.select(
        conv_col, turn_col, F.when(kind == 4, F.lit("user")).otherwise(space(role_col)).alias(role_col),
        text.alias(text_col), (kind == 0).alias(gone),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("__copy")).drop("__copy")


def judged_rows(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", gone: str | None = None) -> DataFrame:
    """One row per distinct row of a conversation: ``__conv, turn, role, text, n`` (copies; 0 for a
    conversation's gone rows), ``blank, seen`` (role and text stand at an earlier turn), ``truncated``."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    left = F.lit(True) if gone is None else ~F.coalesce(F.col(gone), F.lit(False))
    rows = df.select(
        F.col(conv_col).alias("__conv"), F.when(left, F.col(turn_col).cast("long")).alias("turn"),
        F.when(left, space(role_col)).alias("role"), F.when(left, space(text_col)).alias("text"),
        left.cast("long").alias("n"))
    rows = rows.groupBy("__conv", "turn", "role", "text").agg(F.sum("n").alias("n"))
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")      # nulls first
    first = (rows.filter("role is not null").groupBy("__conv", "role", "text").agg(F.min(at).alias("first"))
             .select(F.col("__conv").alias("c"), F.col("role").alias("r"), F.col("text").alias("t"), "first"))
    same = F.col("__conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text") == F.col("t"))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    whole = F.col("text").rlike(rf"[.!?]{_BLANK}*\z")
    return rows.join(first, same, "left").select(
        "__conv", "turn", "role", "text", "n", F.coalesce(blank, F.lit(False)).alias("blank"),
        F.coalesce(~F.col("first").eqNullSafe(at) & F.col("role").isNotNull(), F.lit(False)).alias("seen"),
        (~blank & ~whole).alias("truncated"))


def _in_order(judged: DataFrame) -> DataFrame:
    text = F.when(~F.col("blank") & ~F.col("seen"), F.col("text")).alias("text")
    order = ["__conv", F.asc_nulls_first("turn"), "role", "__text"]
    return (judged.select("__conv", "turn", "role", F.col("text").alias("__text"), text, "n", "blank", "seen", "truncated")
            .repartition("__conv").sortWithinPartitions(*order).drop("__text"))


class _Summary:
    """Counts and the search of one conversation."""

    def __init__(self, conv):
        self.conv, self.repair = conv, Repair()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.last_turn = self.last = None

    def add(self, turn, role, text, n, blank, seen, truncated) -> None:
        if not n:
            return
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = self.last_turn = turn
        initial = role[:1]
        if self.last is not None and (self.last, initial) not in _LEGAL:
            self.illegal += 1
        self.illegal += n - 1               # copies follow each other
        self.last = initial
        if blank:
            self.blank += n
        else:
            self.duplicate += n if seen else n - 1
            self.truncated += int(truncated and not seen)
        for k in range(n):
            self.repair.add(role, text, blank or seen or k > 0, truncated)

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.result())


_FIELDS = ("__conv", "turn", "role", "text", "n", "blank", "seen", "truncated")


def repair_conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", gone: str | None = None) -> DataFrame:
    """One row per conversation: faults, cost, audit and digest of the repaired text.

    ``gone`` names a boolean column of rows that aren't there any more: they are not read, but
    their conversation is reported."""
    schema = SUMMARY.format(id=df.schema[conv_col].dataType.simpleString())
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Summary | None = None
        for batch in batches:
            done = []
            for row in zip(*(batch.column(f).to_pylist() for f in _FIELDS)):
                if now is None or row[0] != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Summary(row[0])
                now.add(*row[1:])
            if done:
                yield _batch(done, names, batch.schema.field("__conv").type)
            kind = batch.schema.field("__conv").type
        if now is not None:
            yield _batch([now.row()], names, kind)

    rows = _in_order(judged_rows(df, conv_col, turn_col, role_col, text_col, gone))
    return rows.mapInArrow(run, schema).withColumnRenamed("__conv", conv_col)


def _batch(rows: list[tuple], names: list[str], id_type: pa.DataType) -> pa.RecordBatch:
    types = [id_type] + [pa.int64()] * 6 + [pa.string()] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def repaired_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text", gone: str | None = None) -> DataFrame:
    """The repaired conversations: ``conv, place`` (from 0), ``edit, turn, role, text``.

    The audit of each conversation meets its rows in order; inserted rows have no turn."""
    audits = repair_conversations(df, conv_col, turn_col, role_col, text_col, gone)
    id_type = df.schema[conv_col].dataType.simpleString()
    rows = judged_rows(df, conv_col, turn_col, role_col, text_col, gone).filter("n > 0")
    both = (audits.select(F.col(conv_col).alias("__conv"), F.lit(None).cast("long").alias("turn"),
                          F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"),
                          F.lit(0).cast("long").alias("n"))
            .unionByName(rows.select("__conv", "turn", "role", "text", "n")))
    # the audit has n = 0 and leads
    stream = both.repartition("__conv").sortWithinPartitions(
        "__conv", (F.col("n") > 0), F.asc_nulls_first("turn"), "role", "text")
    schema = f"__conv {id_type}, place long, edit string, turn long, role string, text string"
    spoken = dict(_SPOKEN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, place, count = "", 0, START, 0
        conv, kind = None, None

        def inserted(out) -> None:
            nonlocal at, place, count
            while at < len(audit) and audit[at] == INSERT:
                role, place = spoken[place]
                out.append((conv, count, INSERT, None, role, ""))
                at, count = at + 1, count + 1

        for batch in batches:
            out, kind = [], batch.schema.field("__conv").type
            for c, turn, role, text, n in zip(*(batch.column(f).to_pylist() for f in ("__conv", "turn", "role", "text", "n"))):
                if not n:
                    conv, audit, at, place, count = c, text, 0, START, 0
                    inserted(out)
                    continue
                for _ in range(n):
                    edit = audit[at]
                    at += 1
                    if edit == KEEP:
                        place = _KEPT[place, role[:1]]
                        out.append((conv, count, edit, turn, role, text))
                    elif edit == REROLE:
                        new, place = spoken[place]
                        out.append((conv, count, edit, turn, new, text))
                    count += edit != DELETE
                    inserted(out)
            if out:
                types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)],
                                                 ["__conv", "place", "edit", "turn", "role", "text"])

    return stream.mapInArrow(run, schema).withColumnRenamed("__conv", conv_col)
