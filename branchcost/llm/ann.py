"""Approximate nearest neighbours from low-dimensional stable projections.

Every vector is projected to `DIMS` dimensions with one Gaussian matrix.
Gaussian numbers are 2-stable, so the squared projected distance of two
vectors is their squared distance times a chi-squared variable with `DIMS`
degrees of freedom. Neighbours in the projection are therefore visited in
order of projected distance, each is verified on the original vectors, and
the visit stops when the next projected distance is so large, against the
k-th best verified one, that a nearer vector would be there with probability
below 1 - `CONFIDENCE` (the chi-squared test).

The projections are indexed by a kd-tree in two levels. The upper level is
fitted on a bounded sample and deals all vectors to cells, whose number grows
with the table, and cells of more than `BLOCK` vectors to blocks by id; the
lower level is a kd-tree over each block, built by the task that searches it.
A query searches a block of its own cell first; its k-th distance there gives,
by the same test, the cells that can still matter, and only those are searched
next. Queries are dealt to chunks by their cells, so that those of a chunk
visit much the same blocks, and a block goes only to the chunks that visit it.

The sample is `SAMPLE` vectors, or `CELL_SAMPLE` for each cell if that is
more; with `MAX_CELLS` cells at most it stays below 132,000. Vectors of
different lengths have no distance; each length is searched by itself.

Equal vectors are one entry with their smallest ids, so a vector that a third
of the rows share is searched once, and queries with equal vectors are one
search.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from branchcost.llm.common import stage_table

DIMS = 12
CONFIDENCE = 0.985
SAMPLE = 20_000
CELL_SAMPLE = 16
MAX_CELLS = 8_192
BLOCK = 4_096
LEAF = 64
QUERY_BLOCK = 2_000
SEED = 11


def chi_squared_quantile(p: float, dof: int) -> float:
    """Quantile for even degrees of freedom (closed-form tail, bisected)."""

    def tail(x: float) -> float:
        term = total = 1.0
        for i in range(1, dof // 2):
            term *= x / 2 / i
            total += term
        return math.exp(-x / 2) * total

    lo, hi = 0.0, 50.0 * dof
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if tail(mid) > 1 - p else (lo, mid)
    return hi


def projection(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dim, DIMS))


class KdTree:
    """Leaves of at most `leaf` points, split at the median of the widest dimension."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.leaves: list[np.ndarray] = []
        todo = [np.arange(len(points))]
        while todo:
            idx = todo.pop()
            spread = np.ptp(points[idx], axis=0) if len(idx) > leaf else np.zeros(1)
            if spread.max() <= 0:
                self.leaves.append(idx)
                continue
            order = idx[np.argsort(points[idx, int(spread.argmax())], kind="stable")]
            todo += [order[: len(order) // 2], order[len(order) // 2 :]]
        self.low = np.array([points[i].min(0) for i in self.leaves])
        self.high = np.array([points[i].max(0) for i in self.leaves])

    def distances(self, q: np.ndarray) -> np.ndarray:
        """Squared distance of `q` to the box of each leaf."""
        gap = np.maximum(0, np.maximum(self.low - q, q - self.high))
        return (gap * gap).sum(1)


def search(tree: KdTree, flat: np.ndarray, vectors: np.ndarray, q: np.ndarray, q_flat: np.ndarray, k: int, bound: float, ratio: float):
    """(rows, squared distances) of the k nearest found; `bound` is a known k-th squared distance."""
    best = np.zeros(0, int)
    dist = np.zeros(0)
    reach = tree.distances(q_flat)
    for leaf in np.argsort(reach, kind="stable"):
        if reach[leaf] > ratio * bound:
            break
        idx = tree.leaves[leaf]
        gap = flat[idx] - q_flat
        idx = idx[(gap * gap).sum(1) <= ratio * bound]
        if not len(idx):
            continue
        diff = vectors[idx] - q
        best, dist = np.append(best, idx), np.append(dist, (diff * diff).sum(1))
        if len(best) > k:
            # all ties of the k-th stay, ids decide later
            kth = np.partition(dist, k - 1)[k - 1]
            best, dist = best[dist <= kth], dist[dist <= kth]
            bound = min(bound, kth)
        elif len(best) == k:
            bound = min(bound, dist.max())
    return best, dist


class Cells:
    """Upper kd-tree, fitted on a sample: split dimension and value per inner node."""

    def __init__(self, points: np.ndarray, n_cells: int):
        self.nodes: list[tuple] = []  # (dimension, value, left, right) or (cell,)
        self.n = 0
        self._grow(points, n_cells)

    def _grow(self, points: np.ndarray, n_cells: int) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        spread = np.ptp(points, axis=0) if len(points) > 1 else np.zeros(1)
        if n_cells < 2 or spread.max() <= 0:
            self.nodes[at] = (self.n,)
            self.n += 1
            return at
        d = int(spread.argmax())
        value = float(np.median(points[:, d]))
        left = points[:, d] < value
        if not left.any() or left.all():
            value = float(points[:, d].mean())
            left = points[:, d] < value
        a = self._grow(points[left], n_cells // 2)
        b = self._grow(points[~left], n_cells - n_cells // 2)
        self.nodes[at] = (d, value, a, b)
        return at

    def of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            at, idx = todo.pop()
            node = self.nodes[at]
            if len(node) == 1:
                out[idx] = node[0]
            elif len(idx):
                left = points[idx, node[0]] < node[1]
                todo += [(node[2], idx[left]), (node[3], idx[~left])]
        return out


def _chunks(counts: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(cell, first chunk, chunks) for (cell, queries) in cell order.

    Neighbouring cells, which have neighbouring numbers, share a chunk of at
    most `QUERY_BLOCK` queries; a cell with more has several of its own.
    """
    out, at, room = [], -1, 0
    for cell, n in counts:
        many = -(-n // QUERY_BLOCK)
        if many > 1 or n > room:
            at += 1
            room = QUERY_BLOCK if many == 1 else 0
        out.append((cell, at, many))
        at, room = at + many - 1, room - n if many == 1 else 0
    return out


def _matrix(column) -> np.ndarray:
    return np.array([np.asarray(x, np.float64) for x in column])


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part.

    Vectors that are null, empty, zero or hold a null, NaN or infinity take
    no part, nor do rows without an id. Rows that repeat an id count once,
    with the smallest of their vectors.
    """
    vec = F.transform(F.col(vec_col), lambda x: x.cast("double") + F.lit(0.0))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec")).where("vec_id IS NOT NULL")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce(finite, F.lit(False)) & F.exists("vec", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))


def nearest(
    df: DataFrame,
    is_query,
    k: int = 10,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row.

    `is_query` is a Column over `vec_id`. Score is the Euclidean distance in
    double precision; ties go to the smaller id; a query is not its own
    neighbour. The candidates of a query are the vectors of its own length
    (one search for each length in the table). An empty table gives no rows;
    fewer than k candidates are all returned.
    """
    rows = usable(df, id_col, vec_col).withColumn("dim", F.size("vec"))
    lengths = sorted(r["dim"] for r in rows.select("dim").distinct().collect())
    if not lengths:
        return df.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    found = [_nearest_of_length(rows.where(F.col("dim") == dim), is_query, k, dim) for dim in lengths]
    return reduce(DataFrame.unionByName, found)


def _nearest_of_length(rows: DataFrame, is_query, k: int, dim: int) -> DataFrame:
    spark = rows.sparkSession
    # k + 1 ids of each distinct vector suffice: a query leaves out at most its own
    place = Window.partitionBy("vec").orderBy("vec_id")
    classes = (
        rows.select("vec", "vec_id")
        .withColumn("place", F.row_number().over(place))
        .where(F.col("place") <= k + 1)
        .groupBy("vec")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("id", F.element_at("ids", 1))
    )
    matrix = spark.sparkContext.broadcast(projection(dim))

    def project(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series(list(_matrix(b) @ matrix.value) if len(b) else [], dtype=object)

    flat = F.pandas_udf(project, "array<double>")
    classes = stage_table(classes.withColumn("flat", flat("vec")), "ann-vectors")
    n = classes.count()
    n_cells = min(MAX_CELLS, max(1, n // BLOCK))
    sample = classes.orderBy(F.xxhash64("id"), "id").limit(max(SAMPLE, CELL_SAMPLE * n_cells)).select("flat").collect()
    cells = Cells(_matrix([r["flat"] for r in sample]), n_cells)
    tree = spark.sparkContext.broadcast(cells)

    def cell_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series(tree.value.of(_matrix(b)) if len(b) else [], dtype="int64")

    cell = F.pandas_udf(cell_of, "bigint")
    placed = stage_table(classes.withColumn("cell", cell("flat")), "ann-cells")
    # one row for each cell: its size and box
    box = [f(F.col("flat")[d]).alias(f"{name}{d}") for d in range(DIMS) for f, name in ((F.min, "lo"), (F.max, "hi"))]
    stats = sorted(placed.groupBy("cell").agg(F.count("*").alias("n"), *box).collect(), key=lambda r: r["cell"])
    blocks = {r["cell"]: -(-r["n"] // BLOCK) for r in stats}
    lows = np.array([[r[f"lo{d}"] for d in range(DIMS)] for r in stats])
    highs = np.array([[r[f"hi{d}"] for d in range(DIMS)] for r in stats])
    shared = spark.sparkContext.broadcast((lows, highs, [r["cell"] for r in stats], blocks))
    ratio = chi_squared_quantile(CONFIDENCE, DIMS)

    # a row for each cell, at most MAX_CELLS
    sizes = F.broadcast(spark.createDataFrame(list(blocks.items()), "cell bigint, n_blocks bigint"))
    points = placed.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("id"), "n_blocks"))

    asked = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vec")
    queries = asked.groupBy("vec").agg(F.min("query_id").alias("q"))
    queries = stage_table(queries.withColumn("flat", flat("vec")).withColumn("cell", cell("flat")), "ann-queries")
    chunks = _chunks(sorted((r["cell"], r["count"]) for r in queries.groupBy("cell").count().collect()))
    dealt = F.broadcast(spark.createDataFrame(chunks, "cell bigint, first_chunk bigint, n_chunks bigint"))
    own = F.pmod(F.xxhash64("q"), "n_blocks")
    chunk = F.col("first_chunk") + F.pmod(F.xxhash64("q"), "n_chunks")
    queries = queries.join(sizes, "cell").withColumn("block", own).join(dealt, "cell").withColumn("chunk", chunk)
    queries = queries.select("q", "vec", "flat", "cell", "block", "chunk")

    def visit(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(left) and len(right):
            vectors, low = _matrix(left["vec"]), _matrix(left["flat"])
            index = KdTree(low)
            for q, vec, q_flat, bound in zip(right["q"], right["vec"], right["flat"], right["bound"]):
                found, dist = search(
                    index, low, vectors, np.asarray(vec, float), np.asarray(q_flat, float), k + 1, float(bound), ratio
                )
                near = sorted((d, i) for j, d in zip(found, np.sqrt(dist)) for i in left["ids"].iloc[j])
                out += [(int(q), int(i), float(d)) for d, i in near[: k + 1]]
        return pd.DataFrame(out, columns=["q", "vec_id", "score"]).astype({"q": "int64", "vec_id": "int64", "score": "float64"})

    def searched(routes: DataFrame) -> DataFrame:
        key = ["cell", "block", "chunk"]
        # a block of vectors meets one chunk of queries at a time, of those that visit it
        used = routes.select("cell", "block", F.col("chunk").alias("visitor")).distinct()
        return (
            points.join(used, ["cell", "block"])
            .select("cell", "block", "visitor", "vec", "flat", "ids")
            .groupBy("cell", "block", "visitor")
            .cogroup(routes.select(*key, "q", "vec", "flat", "bound").groupBy(*key))
            .applyInPandas(visit, "q bigint, vec_id bigint, score double")
        )

    first = stage_table(searched(queries.withColumn("bound", F.lit(float("inf")))), "ann-first")
    kth = first.groupBy("q").agg(F.count("*").alias("n"), F.max("score").alias("d"))
    bounded = queries.join(kth, "q", "left").withColumn(
        "bound", F.when(F.col("n") >= k + 1, F.col("d") * F.col("d") * (1 + 1e-12)).otherwise(float("inf"))
    )

    def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lo, hi, names, counts = shared.value
        for b in batches:
            out = []
            for q, vec, q_flat, at, skip, mine, bound in zip(
                b["q"], b["vec"], b["flat"], b["cell"], b["block"], b["chunk"], b["bound"]
            ):
                gap = np.maximum(0, np.maximum(lo - np.asarray(q_flat), np.asarray(q_flat) - hi))
                for c in np.flatnonzero((gap * gap).sum(1) <= ratio * bound):
                    out += [
                        (q, vec, q_flat, names[c], x, mine, bound)
                        for x in range(counts[names[c]])
                        if not (names[c] == at and x == skip)
                    ]
            yield pd.DataFrame(out, columns=["q", "vec", "flat", "cell", "block", "chunk", "bound"])

    second_routes = stage_table(
        bounded.select("q", "vec", "flat", "cell", "block", "chunk", "bound").mapInPandas(
            others, "q bigint, vec array<double>, flat array<double>, cell bigint, block bigint, chunk bigint, bound double"
        ),
        "ann-routes",
    )
    near = first.unionByName(searched(second_routes))
    best = Window.partitionBy("q").orderBy("score", "vec_id")
    near = stage_table(near.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1), "ann-near")
    named = asked.join(queries.select("vec", "q"), "vec").select("query_id", "q")
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        named.join(near, "q")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
