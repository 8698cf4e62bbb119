"""Embedding near-dedup: an exact metric range join inside each label.

Unit vectors are points; cosine >= 0.93 is a chord of at most r = sqrt(2 - 2 * 0.93).

1. Equal vectors of a label become one node with a multiplicity, so a vector that a
   third of all rows share is one point.
2. Pivots (a hashed draw of nodes) part every label: a vector's home is its
   nearest pivot.  If x has home j and d(x, y) <= r, the triangle inequality gives
   d(y, pj) <= d(y, p_home) + 2r, so y is copied to every such cell j, except where
   y lies further than r from the plane between the two pivots.  All partners of a
   vector are then in its home cell and cells join independently.
3. A cell of more than CELL_ROWS rows is a label of its own and is parted again by its
   own pivots: its home vectors ask, all its vectors answer.  It stays whole where
   pivots don't prune (the copies would reach half of all its vectors in each new cell) and
   where it holds more than half of the cell it came from.
4. Cells that stay large are cut into chunks; chunk meets chunk, in blocks, in double
   precision.  Each vector counts its own links in its home cell, and each block sends
   one edge per vector (to its block component's first node), not one per pair.
5. Components of these edges; results go back to the copies.

A cell has PIVOTS_A_CELL pivots for each CELL_ROWS vectors, MAX_PIVOTS at most.  They travel by the
shuffle, once to each slot of about CELL_ROWS rows of their cell: nothing is collected or broadcast, and a
slot is what a task holds.  Random high-dimensional vectors are all about equally far apart: no
metric bound prunes them and the work within a label then grows with the square of its distinct vectors.

Null, zero or non-finite vectors and null labels: no links, own component.  Vectors of
different lengths never link.  Repeated rows are separate vectors (links to each other).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowlake.llm.common import sorted_groups, written
from flowlake.llm.components import components

COSINE = 0.93
CELL_ROWS = 4096
PIVOTS_A_CELL = 2
MAX_PIVOTS = 512
CELL = ["label", "dim", "cell"]
SLACK = 1e-9


def _matrix(vectors) -> np.ndarray:
    """Rows, each scaled by a power of two to a largest component of 0.5 to 1: no square over- or
    underflows, and as the scaling is exact, no cosine changes by a bit."""
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    _, exponent = np.frexp(np.abs(x).max(axis=1))
    return np.ldexp(x, -exponent[:, None])


def chords(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances between unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (x @ pivots.T), 0))


def cells_of(x: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit vector, and which cells it is copied to."""
    d = chords(x, pivots)
    home = d.argmin(1)
    near = d[np.arange(len(x)), home][:, None]
    apart = chords(pivots, pivots)[home]
    triangle = d <= near + 2 * radius + SLACK
    plane = d ** 2 - near ** 2 <= 2 * radius * apart + SLACK
    member = triangle & plane
    member[np.arange(len(x)), home] = True
    return home, member


def block_links(x: np.ndarray, y: np.ndarray, x_node: np.ndarray, y_node: np.ndarray,
                y_copies: np.ndarray, cosine: float, rows: int = 512
                ) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of each query row (counting copies) and edges that connect the block."""
    nodes, at = np.unique(np.concatenate([x_node, y_node]), return_inverse=True)
    xi, yi = at[:len(x_node)], at[len(x_node):]
    group = np.arange(len(nodes))
    links = np.zeros(len(x), np.int64)
    x_norm, y_norm = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    for start in range(0, len(x), rows):
        part = slice(start, start + rows)
        hit = (x[part] @ y.T) / (x_norm[part, None] * y_norm[None]) >= cosine
        hit &= x_node[part, None] != y_node[None]
        links[part] = hit @ y_copies
        for k in np.flatnonzero(hit.any(1)):
            reached = np.unique(np.append(group[yi[hit[k]]], group[xi[start + k]]))
            if len(reached) > 1:
                group[np.isin(group, reached)] = reached[0]
    edges = [(int(nodes[k]), int(nodes[g])) for k, g in enumerate(group) if k != g]
    return links, edges


def split(cells: DataFrame, sizes: DataFrame, radius: float) -> DataFrame:
    """Rows of ``cells`` in new cells, ``parent`` being the old one.  ``sizes``: the cells' rows ``n``."""
    sized = cells.join(sizes.select(*CELL, "n"), CELL)
    slots = F.ceil(F.col("n") / CELL_ROWS).cast("int")
    rank = F.row_number().over(Window.partitionBy(*CELL).orderBy(F.xxhash64("__node", "cell"), "__node"))
    pivots = (sized.filter("home").select(*CELL, "n", "__node", "vec", rank.alias("pivot"))
              .filter(F.col("pivot") <= MAX_PIVOTS)
              .filter(F.col("pivot") <= F.ceil(F.col("n") * PIVOTS_A_CELL / CELL_ROWS)))
    sent = pivots.select(*CELL, F.explode(F.sequence(F.lit(0), slots - 1)).alias("slot"), "pivot", "__node",
                         F.lit(0).cast("long").alias("copies"), "vec", F.lit(False).alias("home"))
    rows = sized.select(*CELL, F.pmod(F.xxhash64(F.lit(5), "__node"), slots).cast("int").alias("slot"),
                        F.lit(0).alias("pivot"), "__node", "copies", "vec", "home")
    slot = [*CELL, "slot"]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in sorted_groups(batches, slot):
            drawn, part = group[group["pivot"] > 0].sort_values("pivot"), group[group["pivot"] == 0]
            if not len(drawn) or not len(part):     # without a home vector nobody asks
                continue
            pivots = _unit(_matrix(drawn["vec"]))
            for start in range(0, len(part), 512):
                some = part.iloc[start:start + 512]
                home, member = cells_of(_unit(_matrix(some["vec"])), pivots, radius)
                at, cell = np.nonzero(member)
                out = some.iloc[at].rename(columns={"cell": "parent"})
                out["home"] = out["home"].to_numpy() & (home[at] == cell)
                out["cell"] = [f"{p}.{c}" for p, c in zip(out["parent"], cell)]
                yield out[["label", "dim", "cell", "parent", "__node", "copies", "vec", "home"]]

    return (sent.unionByName(rows).repartition(*slot).sortWithinPartitions(*slot)
            .mapInPandas(place, "label string, dim int, cell string, parent string, __node long, copies long, "
                                "vec array<double>, home boolean"))


def parted(nodes: DataFrame, radius: float) -> DataFrame:
    """(label, dim, cell, node, copies, vec, home): every node once at home, and where it may answer."""
    columns = [*CELL, "__node", "copies", "vec", "home"]
    todo = nodes.withColumns({"cell": F.lit(""), "home": F.lit(True)}).select(*columns)
    sizes, final = todo.groupBy(*CELL).agg(F.count("*").alias("n")), []
    while True:
        parts = written(split(todo, sizes, radius), "cells")
        counted = (parts.groupBy(*CELL, "parent").agg(F.count("*").alias("n"))
                   .join(sizes.select("label", "dim", F.col("cell").alias("parent"), F.col("n").alias("before")),
                         ["label", "dim", "parent"]))
        # new cells stay where they hold less than half of the old one's rows on average
        among = Window.partitionBy("label", "dim", "parent")
        pays = F.sum("n").over(among) * 2 <= F.col("before") * F.count("*").over(among)
        known = written(counted.withColumn("pays", pays).withColumn(
            "again", F.col("pays") & (F.col("n") > CELL_ROWS) & (F.col("n") * 2 <= F.col("before"))), "cell-sizes")
        kept = known.filter("not pays").select("label", "dim", F.col("parent").alias("cell")).distinct()
        ready = known.filter("pays and not again").select(*CELL)
        final += [todo.join(kept, CELL, "left_semi"), parts.select(*columns).join(ready, CELL, "left_semi")]
        sizes = known.filter("again").select(*CELL, "n")
        if sizes.isEmpty():
            break
        todo = parts.select(*columns).join(sizes.select(*CELL), CELL, "left_semi")
    out = final[0]
    for frame in final[1:]:
        out = out.unionByName(frame)
    return out


def dedup_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                  label_col: str = "label", cosine: float = COSINE) -> DataFrame:
    """One row per row of ``df``: the id, ``n_links``, ``component_id``, ``kept``."""
    spark = df.sparkSession
    radius = math.sqrt(2 - 2 * cosine)
    v = F.col("__vec")
    rows = df.select(F.col(id_col).alias("__id"), F.col(label_col).cast("string").alias("__label"),
                     F.col(vector_col).cast("array<double>").alias("__vec"))
    usable = (F.col("__label").isNotNull() & v.isNotNull()
              & F.forall(v, lambda e: F.coalesce((F.abs(e) < float("inf")) & ~F.isnan(e), F.lit(False)))
              & F.exists(v, lambda e: e != 0))
    usable = F.coalesce(usable, F.lit(False))
    keyed = rows.withColumns({
        "__node": F.when(usable, F.xxhash64("__label", "__vec")),
        "__check": F.when(usable, F.xxhash64(F.lit(7), "__vec", "__label"))})
    nodes = written(
        keyed.filter(F.col("__node").isNotNull()).groupBy("__node", "__check").agg(
            F.count("*").alias("copies"), F.min("__id").alias("low"), F.first("__label").alias("label"),
            F.first("__vec").alias("vec")).withColumn("dim", F.size("vec")), "vectors")

    key = CELL
    placed = written(parted(nodes, radius), "placed")
    chunks = (placed.groupBy(*key).agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias("chunks")))
    chunked = (placed.join(chunks, key)
               .withColumn("own", F.pmod(F.xxhash64(F.lit(3), "__node"), F.col("chunks")).cast("int")))
    each = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    # a row asks in the blocks of its own row and answers in those of its own column
    asking = chunked.filter("home").select(*key, "__node", "copies", "vec", F.col("own").alias("i"),
                                           each.alias("j"), F.lit(True).alias("asks"))
    answering = chunked.select(*key, "__node", "copies", "vec", each.alias("i"),
                               F.col("own").alias("j"), F.lit(False).alias("asks"))
    block = [*key, "i", "j"]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in sorted_groups(batches, block):
            ask, answer = group[group["asks"]], group[~group["asks"]]
            if not len(ask) or not len(answer):
                continue
            links, edges = block_links(
                _matrix(ask["vec"]), _matrix(answer["vec"]), ask["__node"].to_numpy(),
                answer["__node"].to_numpy(), answer["copies"].to_numpy(), cosine)
            some = np.flatnonzero(links)
            yield pd.DataFrame({"a": ask["__node"].to_numpy()[some], "b": 0, "n": links[some]})
            if edges:
                yield pd.DataFrame([(a, b, 0) for a, b in edges], columns=["a", "b", "n"])

    found = written(
        asking.unionByName(answering).repartition(*block).sortWithinPartitions(*block)
        .mapInPandas(search, "a long, b long, n long"), "vector-links")
    counted = found.filter("n > 0").groupBy(F.col("a").alias("__node")).agg(F.sum("n").alias("links"))
    linked = components(found.filter("n = 0")).select(F.col("node").alias("__node"), "root")
    known = (nodes.select("__node", "__check", "copies", "low").join(counted, "__node", "left")
             .join(linked, "__node", "left"))
    roots = known.filter("root is not null").groupBy("root").agg(F.min("low").alias("least"))
    answers = (known.join(roots, "root", "left")
               .select("__node", "__check", F.coalesce("least", "low").alias("__component"),
                       (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("__links")))
    component = F.coalesce("__component", "__id")
    return (keyed.select("__id", "__node", "__check").join(answers, ["__node", "__check"], "left")
            .select(F.col("__id").alias(id_col), F.coalesce("__links", F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"),
                    F.coalesce(F.col("__id") == component, F.lit(False)).alias("kept")))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)
