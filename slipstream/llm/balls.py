"""Codes of vectors by product codebooks, fitted in integers through metric trees.

A vector is cut into ``PARTS`` equal consecutive parts; every part position has a codebook. A round
assigns each part to the nearest entry and replaces each entry by the floored mean of its parts.
What must be found is the nearest entry of every part, in every round.

Metric trees over the parts save most of that work. They follow the anchors hierarchy: points
of a block are given to anchors, each new anchor is the point farthest from the anchor of the widest
ball and takes over the points that are nearer to it (the triangle inequality tells which need no
look). Anchors are merged in pairs, the pair with the smallest common ball first, up to a root
(middle out), and each anchor's own points are split likewise below. A ball keeps its centre,
radius, and the sum and count of its points.

In a round a tree is walked from its root with a list of candidate entries. In a ball an entry goes
from the list if another one is nearer for every point of the ball; children inherit what is left.
A ball whose list has one entry is wholly owned: its sum and count go to the entry, its points are
not touched. In leaves the points are compared with what is left of the list, in integers. Bounds
are tested with a margin for rounding, so codes, ties and sums are exactly those of the full search.

1. Vectors become integers, and tasks build the trees of blocks of at most ``BLOCK`` vectors. One
   row per block holds them; the table is written once and read in every round.
2. The first codebooks are made of the ``ENTRIES`` smallest ids. Codebooks have a fixed size.
3. In a round tasks walk the trees with the codebooks and add up sums and counts per entry; Spark
   adds up what tasks return, and the driver gets ``PARTS * ENTRIES`` entries.
4. A last walk gives every vector its code and error.

Left out are vectors that are null, of another length than ``dims``, or hold null or non-finite
components. Rows are not merged: equal rows and rows that share an id each get a result, and among
the first entries rows of one id come in the order of their components; null ids come last. With
fewer rows than ``ENTRIES`` codebooks are shorter. Components are integers of at most 2^26 in
magnitude after scaling; larger ones raise an error. Other columns are left out. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from slipstream.llm.common import importable, with_names, written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1_024
# Vectors of a block; points of a leaf; how often the anchors of a block are split again at most.
BLOCK, LEAF, DEPTH = 4_096, 24, 6
LARGEST = 1 << 26


@dataclass
class Tree:
    """Balls of a metric tree. Ball b holds points order[first[b]:last[b]]; leaves have no children."""

    order: np.ndarray
    first: np.ndarray
    last: np.ndarray
    left: np.ndarray
    right: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    total: np.ndarray


def _anchors(points: np.ndarray, many: int) -> list[np.ndarray]:
    """Positions of points, dealt to at most ``many`` anchors; one set if all points are equal."""
    # Squared distances of integers are exact in doubles as long as they are below 2^53.
    apart = lambda rows, at: np.sqrt(((points[rows] - points[at]) ** 2).sum(1))
    anchor = [0]
    owner = np.zeros(len(points), np.int64)
    to_owner = apart(slice(None), 0)
    radius = [to_owner.max()]
    while len(anchor) < many:
        widest = int(np.argmax(radius))
        if radius[widest] == 0:
            break
        mine = np.flatnonzero(owner == widest)
        new = int(mine[np.argmax(to_owner[mine])])
        between = apart(np.array(anchor), new)
        # Points nearer to their anchor than half its distance to the new one stay.
        look = np.flatnonzero(to_owner > between[owner] / 2)
        distance = apart(look, new)
        stolen = distance < to_owner[look]
        look, distance = look[stolen], distance[stolen]
        losers = np.unique(owner[look])
        owner[look], to_owner[look] = len(anchor), distance
        anchor.append(new)
        radius.append(distance.max())
        for loser in losers:
            radius[loser] = to_owner[owner == loser].max(initial=0.0)
    return [np.flatnonzero(owner == a) for a in range(len(anchor))]


def _merged(points: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of sets to merge, by number, the pair with the smallest common ball first.

    Merged sets get the numbers after the given ones.
    """
    centre = [points[s].mean(0) for s in sets]
    size = [len(s) for s in sets]
    radius = [np.sqrt(((points[s] - c) ** 2).sum(1).max()) for s, c in zip(sets, centre)]
    n = len(sets)
    centre, radius, size = np.array(centre), np.array(radius), np.array(size)
    common = np.full((n, n), np.inf)
    for i in range(1, n):
        distance = np.sqrt(((centre[:i] - centre[i]) ** 2).sum(1))
        common[i, :i] = np.maximum((distance + radius[:i] + radius[i]) / 2, np.maximum(radius[:i], radius[i]))
    number, out = np.arange(n), []
    for step in range(n - 1):
        i, j = np.unravel_index(np.argmin(common), common.shape)
        out.append((int(number[j]), int(number[i])))
        radius[j] = common[i, j]
        centre[j] = (centre[i] * size[i] + centre[j] * size[j]) / (size[i] + size[j])
        size[j] += size[i]
        number[j] = n + step
        common[i, :] = common[:, i] = np.inf
        number[i] = -1
        alive = np.flatnonzero((number >= 0) & (np.arange(n) != j))
        distance = np.sqrt(((centre[alive] - centre[j]) ** 2).sum(1))
        new = np.maximum((distance + radius[alive] + radius[j]) / 2, np.maximum(radius[alive], radius[j]))
        common[np.maximum(alive, j), np.minimum(alive, j)] = new
    return out


def build(points: np.ndarray) -> Tree:
    """Metric tree over the rows of ``points`` (integers)."""
    points = points.astype(np.float64)
    order, balls = [], []  # a ball is (first, last, left, right)

    def add(rows: np.ndarray, depth: int) -> int:
        """Ball over the given points, with all balls below it."""
        # Equal points end in one leaf, and so does what far outliers leave at the last depth.
        split = len(rows) > LEAF and depth < DEPTH
        sets = _anchors(points[rows], max(2, int(len(rows) ** 0.5))) if split else [rows]
        if len(sets) == 1:
            at = sum(map(len, order))
            order.append(rows)
            balls.append((at, at + len(rows), -1, -1))
            return len(balls) - 1
        merges = _merged(points[rows], sets)
        # Below a merge come the points of both sides, one side after the other.
        below = {len(sets) + k: pair for k, pair in enumerate(merges)}

        def place(number: int) -> int:
            if number < len(sets):
                return add(rows[sets[number]], depth + 1)
            i, j = place(below[number][0]), place(below[number][1])
            balls.append((balls[i][0], balls[j][1], i, j))
            return len(balls) - 1

        return place(len(sets) + len(merges) - 1)

    add(np.arange(len(points)), 0)
    order = np.concatenate(order)
    first, last, left, right = np.array(balls, np.int64).T
    total = np.array([points[order[a:b]].sum(0) for a, b in zip(first, last)])
    centre = total / (last - first)[:, None]
    radius = np.array([
        np.sqrt(((points[order[a:b]] - c) ** 2).sum(1).max()) for a, b, c in zip(first, last, centre)
    ])
    return Tree(order, first, last, left, right, centre, radius, total.astype(np.int64))


def _distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows."""
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * points.shape[1] * most * most < 1 << 53:
        p, e = points.astype(np.float64), entries.astype(np.float64)
        return ((p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)).astype(np.int64)
    out = np.zeros((len(points), len(entries)), np.int64)
    for p, e in zip(points.T, entries.T):
        out += (p[:, None] - e) ** 2
    return out


def walk(tree: Tree, points: np.ndarray, entries: np.ndarray, codes: np.ndarray | None = None):
    """(sums, counts) per entry; fills ``codes`` with the entry of every point, if given."""
    exact = entries.astype(np.float64)
    norms = (exact * exact).sum(1)
    sums = np.zeros(entries.shape, np.int64)
    counts = np.zeros(len(entries), np.int64)
    # Of equal entries the first one wins everywhere.
    unique = np.sort(np.unique(entries, axis=0, return_index=True)[1])
    slack = 1e-9 * (1 + norms.max(initial=0) + (np.abs(tree.centre).max(initial=0) ** 2) * entries.shape[1])
    waiting = [(len(tree.first) - 1, unique)]
    while waiting:
        ball, listed = waiting.pop()
        if len(listed) > 1:
            near = norms[listed] - 2 * (exact[listed] @ tree.centre[ball])
            best = listed[int(np.argmin(near))]
            gap = np.sqrt(((exact[listed] - exact[best]) ** 2).sum(1))
            # How much farther an entry is than the best one, for the point that likes it most.
            listed = listed[near - near.min() - 2 * tree.radius[ball] * gap <= slack]
        first, last = tree.first[ball], tree.last[ball]
        if len(listed) == 1:
            sums[listed[0]] += tree.total[ball]
            counts[listed[0]] += last - first
            if codes is not None:
                codes[tree.order[first:last]] = listed[0]
        elif tree.left[ball] >= 0:
            waiting += [(tree.left[ball], listed), (tree.right[ball], listed)]
        else:
            rows = tree.order[first:last]
            found = listed[np.argmin(_distances(points[rows], entries[listed]), axis=1)]
            np.add.at(sums, found, points[rows])
            np.add.at(counts, found, 1)
            if codes is not None:
                codes[rows] = found
    return sums, counts


def _stored(vectors: DataFrame, dims: int) -> DataFrame:
    """One row per block: ids, labels, integers, and the trees of all parts."""
    label = vectors.schema["label"].dataType.simpleString()
    kind = to_arrow_type(vectors.schema["label"].dataType)
    width = dims // PARTS

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(rows: pa.Table) -> pa.RecordBatch:
            flat = rows.column("embedding").combine_chunks().flatten().to_numpy()
            scaled = np.floor(SCALE * flat.astype(np.float64))
            if np.abs(scaled).max(initial=0) > LARGEST:
                raise ValueError(f"a component is larger than {LARGEST // SCALE} in magnitude")
            points = scaled.astype(np.int32).reshape(-1, dims)
            trees = [build(points[:, i * width:(i + 1) * width]) for i in range(PARTS)]
            fields = {"ids": [rows.column("vec_id").to_pylist()], "labels": [rows.column("label").to_pylist()], "points": [points.tobytes()]}
            for name in Tree.__dataclass_fields__:
                fields[name] = [[getattr(t, name).tobytes() for t in trees]]
            return pa.RecordBatch.from_pydict(fields, schema=schema)

        held, many = [], 0
        schema = pa.schema([
            ("ids", pa.list_(pa.int64())), ("labels", pa.list_(kind)), ("points", pa.binary()),
            *[(name, pa.list_(pa.binary())) for name in Tree.__dataclass_fields__],
        ])
        for batch in batches:
            held.append(batch)
            many += batch.num_rows
            while many >= BLOCK:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, BLOCK))
                held, many = table.slice(BLOCK).to_batches(), many - BLOCK
        if many:
            yield block(pa.Table.from_batches(held))

    trees = ", ".join(f"{name} array<binary>" for name in Tree.__dataclass_fields__)
    return vectors.select("vec_id", "embedding", "label").mapInArrow(
        blocks, f"ids array<bigint>, labels array<{label}>, points binary, {trees}"
    )


def _trees(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[int, np.ndarray, list[Tree]]]:
    width = dims // PARTS
    for at in range(batch.num_rows):
        points = np.frombuffer(batch.column("points")[at].as_py(), np.int32).reshape(-1, dims).astype(np.int64)
        raw = {name: batch.column(name)[at].as_py() for name in Tree.__dataclass_fields__}
        trees = []
        for part in range(PARTS):
            read = lambda name, kind: np.frombuffer(raw[name][part], kind)  # noqa: B023, E731
            trees.append(Tree(
                *[read(name, np.int64) for name in ("order", "first", "last", "left", "right")],
                read("centre", np.float64).reshape(-1, width), read("radius", np.float64),
                read("total", np.int64).reshape(-1, width),
            ))
        yield at, points, trees


def first_codebooks(vectors: DataFrame, dims: int) -> np.ndarray:
    """Codebooks (part, entry, position) of the vectors with the smallest ids."""
    rows = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES).select("embedding").collect()
    scaled = np.floor(SCALE * np.array([r[0] for r in rows], np.float64).reshape(-1, dims)).astype(np.int64)
    return np.ascontiguousarray(scaled.reshape(-1, PARTS, dims // PARTS).transpose(1, 0, 2))


def next_codebooks(blocks: DataFrame, books: np.ndarray, dims: int) -> np.ndarray:
    """Codebooks after one round: floored means, unused entries as they were."""
    width = dims // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(books.shape, np.int64)
        counts = np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for _, points, trees in _trees(batch, dims):
                for part, tree in enumerate(trees):
                    s, c = walk(tree, points[:, part * width:(part + 1) * width], books[part])
                    sums[part] += s
                    counts[part] += c
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array(part), pa.array(entry), pa.array(counts[part, entry]),
            pa.array(list(sums[part, entry]), pa.list_(pa.int64())),
        ], ["part", "entry", "n", "total"])

    at = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"x{i}") for i in range(width)]
    found = blocks.mapInArrow(run, "part long, entry long, n long, total array<bigint>").groupBy(
        "part", "entry"
    ).agg(F.sum("n").alias("n"), *at).collect()
    out = books.copy()
    for row in found:
        out[row.part, row.entry] = [int(row[f"x{i}"]) // row.n for i in range(width)]
    return out


def codes(vectors: DataFrame, dims: int = 64) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for ``vectors(vec_id, embedding, label)``."""
    if dims % PARTS:
        raise ValueError(f"{dims} dimensions cannot be cut into {PARTS} equal parts")
    importable(vectors.sparkSession)
    width = dims // PARTS
    kept = with_names(vectors, ["vec_id", "embedding", "label"]).where(
        F.col("embedding").isNotNull() & (F.size("embedding") == dims)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ).withColumn("vec_id", F.col("vec_id").cast("long"))
    books = first_codebooks(kept, dims)
    blocks = written(_stored(kept, dims))
    for _ in range(ROUNDS if books.shape[1] else 0):
        books = next_codebooks(blocks, books, dims)
    label = kept.schema["label"].dataType.simpleString()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, points, trees in _trees(batch, dims):
                found = np.zeros((PARTS, len(points)), np.int64)
                error = np.zeros(len(points), np.int64)
                for part, tree in enumerate(trees):
                    own = points[:, part * width:(part + 1) * width]
                    walk(tree, own, books[part], found[part])
                    error += ((own - books[part][found[part]]) ** 2).sum(1)
                hexed = found.T.astype(np.uint8).tobytes().hex()
                step = 2 * PARTS
                yield pa.RecordBatch.from_arrays([
                    batch.column("ids")[at].values, batch.column("labels")[at].values,
                    pa.array([hexed[i:i + step] for i in range(0, len(hexed), step)], pa.string()), pa.array(error),
                ], ["vec_id", "label", "code", "error"])

    rows = written(blocks.mapInArrow(coded, f"vec_id long, label {label}, code string, error long"))
    # One row per label and task before the shuffle; the written table's size decides on the join.
    sums = written(rows.groupBy("label").agg(F.sum("error").alias("label_error"))).withColumnRenamed("label", "other")
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return rows.join(sums, F.col("label").eqNullSafe(F.col("other"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
