"""The stages one after the other, and the filtering ones against brute force on odd rows."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline as pipeline
from slipstream.llm import decontam, lines, minhash, toxicity

WHITE = " \t\r\x0b\x0c"
# Names that the operators and stages use themselves.
NAMES = (
    "score", "predicted", "n_lines", "n_removed", "_key", "_split", "_all", "_kept", "_id", "_k", "_order",
    "_bucket", "_part", "_row", "_at", "_rank", "_first", "_other", "_hashes", "_bits", "_group", "n_chars",
)


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    first, tables = docs.columns, []
    for name, stage in pipeline.STAGES:
        tables.append(stage(spark, docs, small))
        if name != "bpe":
            assert tables[-1].columns == first
        assert tables[-1].count() <= docs.count()
        docs = tables[-1]
    got = {r.doc_id: r for r in pipeline.run(spark, small).collect()}
    want = {r.doc_id: r for r in tables[-2].collect()}
    assert got.keys() == want.keys()
    assert all(got[i].text == (want[i].text or "") and got[i].n_tokens == len(got[i].ids) for i in got)


@pytest.fixture(scope="module")
def rows(small, spark):
    rng = random.Random(9)
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").limit(50).collect()]
    prose = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    base = prose(80)
    near = base.split()
    near[40] = "other"
    bench = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").limit(3).collect()]
    found = [*table, *table, *((None, t) for _, t in table)]
    found += [(900, base), (901, " ".join(near)), (902, base), (902, "another text of a used id " + prose(9)), (None, None)]
    found += [(903, None), (904, ""), (905, " \n\t"), (906, prose(4)), (None, prose(4)), (907, "x" * 9_000)]
    found += [(908, prose(30) + " " + bench[0] + " end"), (909, bench[1].split()[0]), (910, prose(6_000))]
    return found


@pytest.fixture(scope="module")
def docs(spark, rows):
    names = [n for n in NAMES if n != "n_chars"]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` double" for n in names) + ", n_chars long, `a.b` string"
    return spark.createDataFrame([(i, t, *[-5.0] * len(names), 7, "kept") for i, t in rows], schema).repartition(3)


def plain(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=lambda r: [(x is not None, x) for x in r])


def test_toxic_stage(spark, docs, rows, small):
    model = toxicity.train(docs, spark.read.parquet(f"{small}/labels.parquet"))
    left = pipeline.reject_toxic(spark, docs, small)
    assert left.columns == docs.columns
    found = left.collect()
    assert all(r["score"] == r["predicted"] == r["_other"] == -5.0 and r["a.b"] == "kept" for r in found)
    want = [(i, t) for i, t in rows if model.score(toxicity.features(t)) < 0.5]
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in found))) == sorted(map(str, want))


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    front = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return len(b) == len(a) + 1 and a[front:] == b[front + 1:]


def test_line_stage(spark, docs, rows, small):
    left = pipeline.remove_repeated_lines(spark, docs, small)
    assert left.columns == docs.columns
    keys = {(r.doc_id, r.text): r.k for r in docs.select("doc_id", "text", lines.text_key().alias("k")).collect()}
    first = {}
    for (i, t), key in keys.items():
        for k, line in enumerate([] if t is None else t.split("\n")):
            line, place = line.strip(WHITE), (i is not None, i or 0, key, k)
            if line:
                first[line] = min(first.get(line, place), place)
    long = {a: p for a, p in first.items() if len(a) >= lines.LEAST}
    near = {a for a, p in long.items() if any(q < p and abs(len(a) - len(b)) < 2 and one_edit(a, b) for b, q in long.items())}

    def kept(i, t):
        return None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if not x.strip(WHITE) or (
            x.strip(WHITE) not in near and first[x.strip(WHITE)] == (i is not None, i or 0, keys[i, t], k)))

    assert plain(left) == sorted(((i, kept(i, t)) for i, t in rows), key=lambda r: [(x is not None, x) for x in r])
    row = left.where("doc_id = 907").first()
    assert row["n_lines"] == row["_split"] == -5.0 and row["n_chars"] == 9_000


def test_group_stage(spark, docs, rows, small):
    left = pipeline.one_of_each_group(spark, docs, small)
    assert left.columns == docs.columns
    sets = [frozenset(minhash.shingles(t, 5).tolist()) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if group[a] != group[b] and (x == y or 5 * len(x & y) >= 4 * len(x | y)):
                group = [group[b] if g == group[a] else g for g in group]
    groups = {}
    for g, (i, t) in zip(group, rows):
        groups.setdefault(g, []).append((i is None, i or 0, t))
    found = left.collect()
    assert len(found) == len(groups)
    for r in found:
        members = next(m for m in groups.values() if (r["doc_id"] is None, r["doc_id"] or 0, r["text"]) in m)
        assert (r["doc_id"] is None, r["doc_id"] or 0) == min(m[:2] for m in members)
        groups = {g: m for g, m in groups.items() if m is not members}
    assert not groups


def test_benchmark_stage(spark, docs, rows, small):
    left = pipeline.decontaminate(spark, docs, small)
    assert left.columns == docs.columns
    items = [r.text.lower().split() for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    w, seeds = decontam.WINDOW, {}
    for item in items:  # of 13 words with 2 others, 4 in a row are equal
        for q in range(len(item) - 3):
            seeds.setdefault(tuple(item[q:q + 4]), []).append((item, q))

    def leaks(text):
        words = (text or "").lower().split()
        for k in range(len(words) - 3):
            for item, q in seeds.get(tuple(words[k:k + 4]), ()):
                for at in range(max(0, k - w + 4), k + 1):
                    to = q - k + at
                    if to >= 0 and at + w <= len(words) and to + w <= len(item):
                        if sum(a == b for a, b in zip(words[at:at + w], item[to:to + w])) >= w - decontam.SUBSTITUTED:
                            return True
        return False

    want = [(i, t) for i, t in rows if not leaks(t)]
    assert len(want) < len(rows)
    assert plain(left) == sorted(want, key=lambda r: [(x is not None, x) for x in r])


def test_empty(spark, docs, small):
    none = docs.limit(0)
    for _, stage in pipeline.STAGES:
        none = stage(spark, none, small)
        assert none.count() == 0
