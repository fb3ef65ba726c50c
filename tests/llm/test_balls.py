"""Vector codes against a full search in Python integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from slipstream.llm import balls

SCHEMA = "vec_id long, embedding array<float>, label int, code string, n int"


def by_brute_force(rows):
    """(vec_id, code, error, label_error, sha) per row, without numpy sums or trees."""
    kept = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v], label) for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    ordered = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:256]
    width = len(kept[0][1]) // 4
    cut = lambda v: [v[p * width:(p + 1) * width] for p in range(4)]
    books = [[cut(v)[p] for _, v, _ in ordered] for p in range(4)]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), k) for k, e in enumerate(book))

    for step in range(5):
        found = [[nearest(cut(v)[p], books[p]) for p in range(4)] for _, v, _ in kept]
        if step == 4:
            break
        for p in range(4):
            for k in range(len(books[p])):
                mine = [cut(v)[p] for (_, v, _), f in zip(kept, found) if f[p][1] == k]
                if mine:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    labels = {}
    for (_, _, label), e in zip(kept, errors):
        labels[label] = labels.get(label, 0) + e
    return [
        (i, "".join(f"{k:02x}" for _, k in f), e, labels[label], sha)
        for (i, _, label), f, e in zip(kept, found, errors)
    ]


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_tree_and_walk(monkeypatch):
    rng = np.random.default_rng(1)
    for n, spread in ((1, 5), (3, 1), (700, 2), (900, 400), (600, 1 << 25)):
        points = rng.integers(-spread, spread + 1, (n, 4))
        points[: n // 3] = points[0]
        entries = np.concatenate([points[:40], points[:5], rng.integers(-spread, spread + 1, (20, 4))])
        if spread == 2:
            points[:300, 0] += 1 << np.arange(300) // 12
        tree = balls.build(points)
        assert sorted(tree.order) == list(range(n)) and (tree.last - tree.first)[-1] == n
        for b in range(len(tree.first)):
            inside = points[tree.order[tree.first[b]:tree.last[b]]]
            assert (inside.sum(0) == tree.total[b]).all()
            assert (np.linalg.norm(inside - tree.centre[b], axis=1) <= tree.radius[b] * (1 + 1e-9) + 1e-9).all()
        codes = np.full(n, -1)
        sums, counts = balls.walk(tree, points, entries, codes)
        distance = ((points[:, None].astype(object) - entries[None]) ** 2).sum(2)
        want = np.array([min(range(len(entries)), key=lambda k: (d[k], k)) for d in distance])
        assert (codes == want).all() and (np.bincount(want, minlength=len(entries)) == counts).all()
        assert all((sums[k] == points[want == k].sum(0)).all() for k in range(len(entries)))


@pytest.mark.parametrize("block", [4_096, 60])
def test_codes(spark, monkeypatch, block):
    monkeypatch.setattr(balls, "BLOCK", block)
    rng = random.Random(2)
    vector = lambda: [rng.gauss(0, 0.4) for _ in range(8)]
    centres = [vector() for _ in range(6)]
    rows = [(k, [x + rng.gauss(0, 0.01) for x in centres[k % 6]] if k % 3 else vector(), k % 4 or None) for k in range(330)]
    same = vector()
    rows += [(1_000 + k, same, 7) for k in range(120)]
    rows += [(3, same, None), (3, same, None), (None, vector(), 1), (-5, [0.0] * 8, 2), (-6, None, 2)]
    rows += [(-7, [1.0] * 7 + [float("nan")], 2), (-8, [float("inf")] * 8, 2), (-9, [None] + [1.0] * 7, 2)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    found = balls.codes(table, 8)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert by_id(map(tuple, found.collect())) == by_id(by_brute_force(rows))


def test_few_and_none(spark):
    rows = [(2, [0.5] * 8, 1), (1, [0.5] * 8, None), (9, [-0.25] * 8, 1)]
    assert by_id(map(tuple, balls.codes(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), 8).collect())) == by_id(by_brute_force(rows))
    assert balls.codes(spark.createDataFrame([], SCHEMA), 8).count() == 0


def test_query(spark, small):
    from slipstream.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert by_id(map(tuple, QUERIES["op11_vector_codes"](spark, small).collect())) == by_id(by_brute_force(rows))
