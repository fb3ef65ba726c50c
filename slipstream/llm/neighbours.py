"""Approximate nearest neighbours by cosine, in a hierarchical k-means tree.

A sample of the vectors is split by k-means into ``BRANCHES`` parts, each part again, until a part
has ``LEAF`` sampled vectors at most. Every vector of the table goes down the tree to the nearest
child each time, to one leaf. A search keeps a priority queue of the nodes it has seen, nearest
centre first: it takes the nearest one, goes down from it to a leaf, and puts the children it passes
by into the queue. The leaves come in the order in which the search visits them (best bin first).

How many leaves are visited is calibrated: for a bounded number of queries the true neighbours are
found by comparing them with every row, and visits are widened until the share of true neighbours
that lie in visited leaves reaches ``recall``. If that takes all leaves, the search is exact.

1. Equal vectors become one class with its smallest ids, as many as a result can hold. The class
   is searched once for all its queries, and a result is full without its other ids.
2. The tree is fitted on at most ``SAMPLE`` classes, in the order of a hash, and goes to the tasks;
   its size is bounded by the sample. Every class is placed in it.
3. Queries are sent to the leaves they visit, to every block of at most about ``BLOCK`` classes of
   a large leaf. A task holds a block, queries are streamed through it. No leaf or block is left
   out. What leaves a task are the best few per query and block.
4. The best ones of all blocks are ranked; each query gets them without its own id.

Scores are cosines in double precision of the given components: candidates are found by a matrix
product with a margin and scored pair by pair. Ties go to the smaller id.

Vectors that are null, zero, of another length than ``dims``, or hold null or non-finite
components take no part, and neither do rows without an id. An id names one vector: of rows that
share an id and differ in the vector the one that is smallest in bytes counts, equal ones count once.
Queries with fewer candidates get all of them. Other columns are left out; an empty table gives no
rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slipstream.llm.common import importable, with_names, written

SAMPLE, BRANCHES, LEAF, DEPTH, STEPS, SEED = 16_384, 8, 128, 40, 8, 5
# Classes of a leaf that a task holds; queries that are compared with every row to calibrate.
BLOCK, CALIBRATED = 8_192, 128
# Most cells of a matrix of scores, and what rounding may take from a score.
CELLS, MARGIN = 1 << 21, 1e-9


@dataclass
class Tree:
    """Centres of all nodes; children of inner nodes, leaf numbers of the others (else -1)."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def place(self, unit: np.ndarray) -> np.ndarray:
        """Leaf of every row, going to the nearest child."""
        out, waiting = np.zeros(len(unit), np.int64), [(0, np.arange(len(unit)))]
        while waiting:
            node, rows = waiting.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            below = self.children[node]
            centres = np.array([self.centres[c] for c in below])
            near = ((centres * centres).sum(1) - 2 * unit[rows] @ centres.T).argmin(1)
            waiting += [(c, rows[near == k]) for k, c in enumerate(below) if (near == k).any()]
        return out

    def visited(self, unit: np.ndarray, most: int) -> Iterator[list[int]]:
        """The first ``most`` leaves that the search of each row visits, in order."""
        centres = np.array(self.centres)
        for row in unit:
            away = ((centres - row) ** 2).sum(1).tolist()
            queue, found = [(0.0, 0)], []
            while queue and len(found) < most:
                node = heapq.heappop(queue)[1]
                while self.leaf[node] < 0:
                    below = sorted((away[c], c) for c in self.children[node])
                    for entry in below[1:]:
                        heapq.heappush(queue, entry)
                    node = below[0][1]
                found.append(self.leaf[node])
            yield found


def fit(unit: np.ndarray) -> Tree:
    """Tree over the sampled unit vectors."""
    tree, draw = Tree(), np.random.default_rng(SEED)

    def add(rows: np.ndarray, depth: int) -> int:
        at = len(tree.leaf)
        tree.centres.append(unit[rows].mean(0) if len(rows) else np.zeros(unit.shape[1]))
        tree.children.append([])
        tree.leaf.append(-1)
        parts = _split(unit[rows], draw) if len(rows) > LEAF and depth < DEPTH else []
        if len(parts) < 2:
            tree.leaf[at] = tree.leaves
            tree.leaves += 1
        else:
            tree.children[at] = [add(rows[p], depth + 1) for p in parts]
        return at

    add(np.arange(len(unit)), 0)
    return tree


def _split(points: np.ndarray, draw: np.random.Generator) -> list[np.ndarray]:
    """Positions of the points of each part that k-means makes; parts without points go."""
    centres = points[draw.choice(len(points), min(BRANCHES, len(points)), replace=False)]
    for _ in range(STEPS):
        near = ((centres * centres).sum(1) - 2 * points @ centres.T).argmin(1)
        centres = np.array([
            points[near == k].mean(0) if (near == k).any() else centres[k] for k in range(len(centres))
        ])
    near = ((centres * centres).sum(1) - 2 * points @ centres.T).argmin(1)
    parts = [np.flatnonzero(near == k) for k in range(len(centres))]
    return [p for p in parts if len(p)]


def _array(column: pa.Array | pd.Series, dims: int) -> np.ndarray:
    values = column.to_pylist() if isinstance(column, pa.Array) else column
    return np.frombuffer(b"".join(values), np.float64).reshape(-1, dims)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(1))[:, None]


def best(
    queries: np.ndarray, members: np.ndarray, ids: list[np.ndarray], most: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query, member, id, score) of the ``most`` nearest ids per query, by position."""
    out = [[np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]]
    size = np.fromiter(map(len, ids), np.int64, len(ids))
    start, flat = np.r_[0, np.cumsum(size)[:-1]], np.concatenate(ids) if len(ids) else np.empty(0, np.int64)
    q_unit, m_unit = _unit(queries), _unit(members)
    step = max(1, CELLS // max(1, len(members)))
    for at in range(0, len(queries), step):
        about = q_unit[at:at + step] @ m_unit.T
        kth = max(0, len(members) - most)
        bar = np.partition(about, kth, axis=1)[:, kth] - MARGIN
        q, m = np.nonzero(about >= bar[:, None])
        a, b = queries[at + q], members[m]
        score = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
        q, m, score = (np.repeat(x, size[m]) for x in (q, m, score))
        first = np.r_[True, (q[1:] != q[:-1]) | (m[1:] != m[:-1])] if len(q) else np.empty(0, bool)
        run = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
        name = flat[start[m] + run]
        order = np.lexsort((name, -score, q))
        q, m, name, score = q[order], m[order], name[order], score[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        for kept, x in zip(out, (q + at, m, name, score)):
            kept.append(x[place < most])
    return tuple(np.concatenate(x) for x in out)


def _classes(vectors: DataFrame, dims: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(vec_id, vector), and (class, vector, ids) of different vectors with their smallest ids."""
    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column("embedding").to_pylist(), np.float64).reshape(-1, dims)
            # Powers of two change no cosine, and keep squares from leaving the range.
            rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, initial=0))[1][:, None]) + 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([r.tobytes() for r in rows], pa.binary())], ["vec_id", "vector"]
            )

    fit_rows = with_names(vectors, ["vec_id", "embedding"]).withColumn("vec_id", F.col("vec_id").cast("long")).where(
        "vec_id is not null and embedding is not null"
    ).where(
        (F.size("embedding") == dims)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    named = written(fit_rows.select("vec_id", "embedding").mapInArrow(scaled, "vec_id long, vector binary").groupBy(
        "vec_id"
    ).agg(F.min("vector").alias("vector")))
    # The limit is applied before the shuffle as well, so a hot vector sends a few rows per task.
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    classes = named.withColumn("place", place).where(F.col("place") <= most).groupBy("vector").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids")
    )
    return named, written(classes.withColumn("class", F.monotonically_increasing_id()))


def _ids(column: pa.Array | pd.Series) -> list[np.ndarray]:
    values = column.to_pylist() if isinstance(column, pa.Array) else column
    return [np.array(v, np.int64) for v in values]


def _needed(placed: DataFrame, queries: DataFrame, tree: Tree, dims: int, k: int) -> list[int]:
    """For true neighbours of some queries: after how many visits their leaf is reached."""
    some = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATED).collect()
    if not some:
        return []
    asked, own = np.array([np.frombuffer(r["vector"], np.float64) for r in some]), [r["vec_id"] for r in some]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = batch.column("leaf").to_numpy()
                q, m, name, score = best(asked, _array(batch.column("vector"), dims), _ids(batch.column("ids")), k + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q), pa.array(name), pa.array(score), pa.array(leaf[m])], ["q", "id", "score", "leaf"]
                )

    found = placed.select("vector", "ids", "leaf").mapInArrow(compared, "q long, id long, score double, leaf long")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "id"))
    rows = found.withColumn("rank", rank).where(F.col("rank") <= k + 1).orderBy("q", "rank").collect()
    order = [{leaf: n + 1 for n, leaf in enumerate(v)} for v in tree.visited(_unit(asked), tree.leaves)]
    out, taken = [], [0] * len(own)
    for row in rows:
        if row["id"] != own[row["q"]] and taken[row["q"]] < k:
            taken[row["q"]] += 1
            out.append(order[row["q"]][row["leaf"]])
    return out


def visits_for(needed: list[int], leaves: int, recall: float) -> int:
    """Visits, widened by a quarter each time, until that share of neighbours is reached."""
    visits = 1
    while visits < leaves and sum(n <= visits for n in needed) < recall * len(needed):
        visits = min(leaves, visits + visits // 4 + 1)
    return visits


def nearest(
    vectors: DataFrame, asked: Column, dims: int = 64, k: int = 5, recall: float = 0.96
) -> DataFrame:
    """(query_id, rank, vec_id, score) for ``vectors(vec_id, embedding)``.

    Queries are the rows for which ``asked``, a condition on ``vec_id``, holds; each gets its ``k``
    nearest rows with another id. ``recall`` is what the calibration must reach.
    """
    spark = vectors.sparkSession
    importable(spark)
    named, classes = _classes(vectors, dims, k + 1)
    sample = classes.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).collect()
    tree = fit(_unit(np.frombuffer(b"".join(r[0] for r in sample), np.float64).reshape(-1, dims)))
    held = spark.sparkContext.broadcast(tree)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = held.value.place(_unit(_array(batch.column("vector"), dims)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], [*batch.schema.names, "leaf"])

    placed = written(classes.select("class", "vector", "ids").mapInArrow(
        put, "class long, vector binary, ids array<bigint>, leaf long"
    ))
    queries = written(named.where(asked).join(classes.select("vector", "class"), "vector"))
    visits = visits_for(_needed(placed, queries, tree, dims, k), tree.leaves, recall)
    # As many rows as the tree has leaves.
    sizes = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}
    blocks = {leaf: -(-n // BLOCK) for leaf, n in sizes.items()}

    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            unit = _unit(_array(rows["vector"], dims))
            goals = [
                [(leaf, b) for leaf in found for b in range(blocks.get(leaf, 0))]
                for found in held.value.visited(unit, visits)
            ]
            flat = np.array([g for found in goals for g in found], np.int64).reshape(-1, 2)
            many = np.fromiter(map(len, goals), np.int64, len(goals))
            yield pd.DataFrame({
                "leaf": flat[:, 0], "block": flat[:, 1], "class": np.repeat(rows["class"].to_numpy(), many),
                "vector": np.repeat(rows["vector"].to_numpy(object), many),
            })

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held_rows, members, ids = None, [], None, None
        for batch in batches:
            leaf, block, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "block", "asks"))
            cut = np.flatnonzero(np.r_[True, (leaf[1:] != leaf[:-1]) | (block[1:] != block[:-1]) | (asks[1:] != asks[:-1])]) if len(leaf) else []
            for a, b in zip(cut, [*cut[1:], len(leaf)]):
                rows = batch.slice(a, b - a)
                if (leaf[a], block[a]) != at:
                    at, held_rows, members = (leaf[a], block[a]), [], None
                # The classes of a block come before its queries, maybe in several batches.
                if not asks[a]:
                    held_rows.append(rows)
                    continue
                if not held_rows:
                    continue
                if members is None:
                    members = np.concatenate([_array(r.column("vector"), dims) for r in held_rows])
                    ids = [x for r in held_rows for x in _ids(r.column("ids"))]
                q, _, name, score = best(_array(rows.column("vector"), dims), members, ids, k + 1)
                yield pa.RecordBatch.from_arrays([
                    rows.column("class").take(pa.array(q)), pa.array(name), pa.array(score),
                ], ["class", "vec_id", "score"])

    none = F.array().cast("array<bigint>")
    own = F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair]) if blocks else None
    number = F.pmod(F.xxhash64("class"), F.element_at(own, F.col("leaf"))) if blocks else F.lit(0).cast("long")
    rows = placed.select("leaf", number.cast("long").alias("block"), F.lit(False).alias("asks"), "class", "vector", "ids").union(
        queries.select("class", "vector").distinct().mapInPandas(
            sent, "leaf long, block long, class long, vector binary"
        ).select("leaf", "block", F.lit(True), "class", "vector", none)
    ).repartition("leaf", "block").sortWithinPartitions("leaf", "block", "asks")
    found = rows.mapInArrow(searched, "class long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("class").orderBy(F.col("score").desc(), "vec_id"))
    results = written(found.withColumn("rank", rank).where(F.col("rank") <= k + 1).groupBy("class").agg(
        F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("all")
    ))
    others = F.filter("all", lambda x: x["vec_id"] != F.col("query_id"))
    return queries.select(F.col("vec_id").alias("query_id"), "class").join(results, "class").select(
        "query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "x")
    ).select("query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", "x.score")
