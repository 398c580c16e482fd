"""Near-equal vectors by an exact metric range join.

On unit vectors a cosine of at least c is a distance of at most eps = sqrt(2 - 2 c). Pivots, drawn from the vectors of a
label, about as many as the root of their number, cut them into cells: a vector is at home with its nearest pivot. Let x
and y be within eps, at home with p and q. By the triangle inequality d(x, q) <= d(x, p) + 2 eps; sharper, the way from x
to y crosses the plane between p and q, so x is no further than eps from it: d(x, q)^2 - d(x, p)^2 <= 2 eps d(p, q). A
vector is copied to every cell for which that holds, so each cell holds all partners of the vectors at home there and is
joined on its own; a large cell is joined in blocks of bounded size. Inside a block vectors are sorted by their distance
to the pivot and, by the triangle inequality again, compared only where these differ by eps or less. Equal vectors are
one class with a count.

A block gives, for its home vectors, the number of links, and one row per linked vector that says with whom it hangs
together inside the block; pairs are not written.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.components import connected
from quern.operators.skew import hot_keys, salted_join
from quern.sources.staging import staged

BLOCK = 4096
# Pivots of all labels together; they are broadcast.
MOST_PIVOTS = 1 << 14
# Numbers in the copies that are made at once inside a task.
VALUES = 1 << 22
# Around the wanted cosine within which a pair is computed again, and around distances within which nothing is passed over.
SLACK, MARGIN = 1e-9, 1e-7
COPIES = "kind long, cell int, home boolean, place double, node long, times long, vector array<double>"


def matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def distances(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * cosines))


def usable(vector: str, label: str) -> str:
    """SQL condition: a label and a vector that is no null, not zero and has only finite components."""
    finite = "x is not null and not isnan(x) and abs(x) < double('Infinity')"
    return f"{label} is not null and {vector} is not null and forall({vector}, x -> {finite}) and exists({vector}, x -> x <> 0)"


def pivots(classes: DataFrame) -> dict[int, np.ndarray]:
    """Unit pivots of every kind with two vectors or more, MOST_PIVOTS of the largest kinds at most; the rest are one cell.

    The vectors with the least hashes are drawn, so the pivots do not depend on the layout.
    """
    sizes = classes.groupBy("kind").count().where("count > 1").orderBy(F.desc("count"), "kind").limit(MOST_PIVOTS).collect()
    total = sum(math.sqrt(r["count"]) for r in sizes)
    scale = min(1.0, MOST_PIVOTS / total) if sizes else 0.0
    wanted = [(r["kind"], n, (2.0 * n + 50) / r["count"]) for r in sizes if (n := round(scale * math.sqrt(r["count"]))) > 0]
    if not wanted:
        return {}
    shares = classes.sparkSession.createDataFrame(wanted, "kind long, wanted long, share double")
    draw = F.xxhash64("node", F.lit("pivot"))
    low = F.pmod(draw, F.lit(1 << 30)) / F.lit(float(1 << 30)) < F.col("share")
    drawn = classes.join(F.broadcast(shares), "kind").where(low).select("kind", "node", "wanted", draw.alias("draw"))  # MOST_PIVOTS rows at most
    rank = F.row_number().over(Window.partitionBy("kind").orderBy("draw", "node"))
    drawn = drawn.withColumn("rank", rank).where("rank <= wanted").select("kind", "node")
    by_kind: dict[int, list] = {}
    for r in classes.join(F.broadcast(drawn), ["kind", "node"]).select("kind", "node", "vector").orderBy("kind", "node").collect():
        by_kind.setdefault(r["kind"], []).append(r["vector"])
    return {kind: unit(np.array(rows, np.float64)) for kind, rows in by_kind.items()}


def cells(vectors: pa.Array, points: np.ndarray, gaps: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, whether the row is at home there, distance to the cell's pivot) of every copy of some vectors."""
    cosines = unit(matrix(vectors)) @ points.T
    nearest = cosines.argmax(1)
    best = cosines[np.arange(len(cosines)), nearest]
    row, cell = np.nonzero(best[:, None] - cosines <= eps * gaps[nearest] + MARGIN)
    return row, cell.astype(np.int32), cell == nearest[row], distances(cosines[row, cell])


def dealt(classes: DataFrame, eps: float) -> DataFrame:
    """COPIES rows: every class in its home cell and in those its neighbourhood may reach."""
    chosen = classes.sparkSession.sparkContext.broadcast(pivots(classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gaps: dict[int, np.ndarray] = {}
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            whole = ~np.isin(kind, np.array(list(chosen.value), np.int64))
            parts = [(np.flatnonzero(whole), None)] if whole.any() else []
            for one in np.unique(kind[~whole]).tolist():
                points = chosen.value[one]
                step = max(1, VALUES // points.size)
                mine = np.flatnonzero(kind == one)
                parts += [(mine[k : k + step], one) for k in range(0, len(mine), step)]
            for mine, one in parts:
                if one is None:
                    row, cell = np.arange(len(mine)), np.zeros(len(mine), np.int32)
                    home, place = np.ones(len(mine), bool), np.zeros(len(mine))
                else:
                    points = chosen.value[one]
                    if one not in gaps:
                        gaps[one] = distances(points @ points.T)
                    row, cell, home, place = cells(batch.column("vector").take(pa.array(mine)), points, gaps[one], eps)
                taken = batch.take(pa.array(mine[row]))
                new = [pa.array(cell), pa.array(home), pa.array(place)]
                yield pa.RecordBatch.from_arrays(
                    [taken.column("kind"), *new, *[taken.column(c) for c in ("node", "times", "vector")]],
                    names=["kind", "cell", "home", "place", "node", "times", "vector"],
                )

    return classes.select("kind", "node", "times", "vector").mapInArrow(run, COPIES)


def hanging(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Least index that each of n points reaches over the links a[k] - b[k]."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def block_links(group: pa.Table, least_cosine: float, eps: float) -> pa.Table:
    """Of one block: node, links (of home vectors), other (a vector that the node hangs together with)."""
    side, place = group["home"].to_numpy(zero_copy_only=False), group["place"].to_numpy()
    node, times = group["node"].to_numpy(), group["times"].to_numpy()
    vectors = unit(matrix(group["vector"].combine_chunks()))
    order = np.argsort(place, kind="stable")
    here, whole = order[side[order]], order[~side[order]]
    found_a, found_b = [], []
    for start in range(0, len(here), 256):
        rows = here[start : start + 256]
        low, high = np.searchsorted(place[whole], [place[rows[0]] - eps - MARGIN, place[rows[-1]] + eps + MARGIN])
        there = whole[low:high]
        cosine = vectors[rows] @ vectors[there].T
        a, b = np.nonzero(cosine >= least_cosine - SLACK)
        close = np.abs(cosine[a, b] - least_cosine) <= SLACK
        exact = np.ones(len(a), bool)
        for k in np.flatnonzero(close):
            x, y = (np.array(group["vector"][int(i)].as_py(), np.float64) for i in (rows[a[k]], there[b[k]]))
            exact[k] = float(x @ y) / (math.sqrt(float(x @ x)) * math.sqrt(float(y @ y))) >= least_cosine
        a, b = rows[a[exact]], there[b[exact]]
        other = node[a] != node[b]
        found_a.append(a[other])
        found_b.append(b[other])
    a, b = np.concatenate([*found_a, np.empty(0, np.int64)]).astype(int), np.concatenate([*found_b, np.empty(0, np.int64)]).astype(int)
    count = np.bincount(a, times[b], len(node)).astype(np.int64)
    distinct, index = np.unique(node, return_inverse=True)
    low = hanging(index[a], index[b], len(distinct))
    linked = np.unique(np.concatenate([index[a], index[b]]))
    nodes = np.concatenate([node[here], distinct[linked]])
    links = np.concatenate([count[here], np.zeros(len(linked), np.int64)])
    root = np.concatenate([node[here], distinct[low[linked]]])
    keep = (links > 0) | (nodes != root)
    return pa.table({"node": nodes[keep], "links": links[keep], "other": root[keep]})


def near_classes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least_cosine: float = 0.98) -> DataFrame:
    """id, n_links, component_id and kept of every vector; vectors link if labels are equal and the cosine is enough.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the least id that links reach, the own one
    included, ``kept`` says whether it is the own one. A null label, a null or zero vector, and one with null or
    non-finite components link with nothing and are kept. Equal vectors of a label link whatever their number; rows with
    one id count one by one. Null ids are passed over as least ids. Vectors of different lengths do not link. Labels may
    be of any type.
    """
    eps = math.sqrt(2 - 2 * least_cosine + 4 * SLACK)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    ready = F.expr(usable("vector", "label"))
    rows = rows.withColumn("kind", F.xxhash64("label", F.size("vector"))).withColumn("node", F.when(ready, F.xxhash64("kind", "vector")))
    own = [F.first(c).alias(c) for c in ("kind", "vector")]
    classes = rows.where("node is not null").groupBy("node").agg(*own, F.count("*").alias("times"), F.min("id").alias("least"))
    classes = staged(classes, "vector-classes")
    copies = staged(dealt(classes, eps), "vector-cells")
    sizes = copies.groupBy("kind", "cell").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.count_if("home") / BLOCK).cast("int").alias("home_blocks"),
    )
    both = copies.join(sizes.where("home_blocks > 0"), ["kind", "cell"])
    numbers = "sequence(0, {} - 1)"
    block = "cast(pmod(node, {}) as int)"
    home = both.where("home").selectExpr("kind", "cell", block.format("home_blocks") + " as i", f"explode({numbers.format('blocks')}) as j", "true as home", "place", "node", "times", "vector")
    all_ = both.selectExpr("kind", "cell", f"explode({numbers.format('home_blocks')}) as i", block.format("blocks") + " as j", "false as home", "place", "node", "times", "vector")
    joined = home.union(all_).groupBy("kind", "cell", "i", "j")
    told = staged(joined.applyInArrow(lambda t: block_links(t, least_cosine, eps), "node long, links long, other long"), "vector-links")
    links = told.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected(told.where("node <> other"), "node", "other")
    known = classes.select("node", "times", "least").join(links, "node", "left").join(roots, "node", "left")
    known = staged(known.withColumns({"root": F.coalesce("root", "node"), "links": F.coalesce("links", F.lit(0))}), "vector-roots")
    groups = known.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("n"))
    known = salted_join(known, groups.select("root", "component"), ["root"], hot_keys(groups, ["root"], "n"), F.col("node"))
    linked = salted_join(rows.where("node is not null").select("id", "node"), known, ["node"], hot_keys(classes, ["node"], "times"), F.col("id"))
    linked = linked.select("id", (F.col("times") - 1 + F.col("links")).cast("long").alias("n_links"), F.col("component"))
    alone = rows.where("node is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return linked.union(alone).select(
        F.col("id").alias(id_col), "n_links", F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept")
    )
