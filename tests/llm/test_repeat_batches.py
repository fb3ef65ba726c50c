from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from slipstream.llm import repeats


def test_windows_in_small_batches(spark, monkeypatch):
    # Rows that share an id, or have none, among texts with common passages.
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join(["a", "b", *words[5:50], "c"]), "short", None, " ".join(words)]
    docs = spark.createDataFrame(list(zip([1, 1, 2, 3, None], texts)), "doc_id long, text string")
    want = sorted(map(str, repeats.remove(docs).collect()))
    assert sum("n_removed=0" in r for r in want) == 2
    monkeypatch.setattr(repeats, "BATCH_ROWS", 1)
    assert sorted(map(str, repeats.remove(docs.repartition(1, F.lit(1))).collect())) == want


def test_anchor_places_are_written_by_document(spark, monkeypatch):
    # A written table holds the places of repeated anchors, one row for each document.
    tables = []
    write = repeats.written
    monkeypatch.setattr(repeats, "written", lambda df: tables.append(write(df)) or tables[-1])
    words = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, words) for i in range(4)], "doc_id long, text string")
    assert {r.n_removed for r in repeats.remove(docs).collect()} == {60}
    by_document = [t for t in tables if t.columns == ["doc_id", "_key", "places"]]
    assert [t.count() for t in by_document] == [4]


def test_words_of_many_texts_at_once():
    texts = [None, "", "a b  c\x0b\x0cd\n", " x " + "y" * 70 + " " + "z" * 64 + " \u00e9 \u00a0 f g\x00 g\x00\x00 g",
             "abcdefgh abcdefghi abcdefgh\x00 a", "q", "q", "\t", "y" * 71 + " " + "y" * 70]
    column = pa.array(["before", *texts]).slice(1)
    words, want = repeats.Words(column), [repeats.words_of(t) for t in texts]
    found = [bytes(words.data[i:i + n]) for i, n in zip(words.starts, words.sizes)]
    assert found == [w for text in want for w in text]
    assert words.counts.tolist() == [len(w) for w in want]
    assert words.places().tolist() == [i for w in want for i in range(len(w))]
    pairs = set(zip(words.hashes().tolist(), found))
    assert len({h for h, _ in pairs}) == len({w for _, w in pairs}) == len(pairs)
    # The hash of a run depends on its words only, not on where they stand.
    hashes = np.tile(np.arange(1, 8, dtype=np.uint64) * np.uint64(repeats.BASES[1]), 3)
    for base in repeats.BASES:
        by_run = repeats.runs(hashes, np.arange(15), 5, base)
        assert (by_run[:7] == by_run[7:14]).all() and len(set(by_run.tolist())) == 7


def test_equal_hashes_of_a_slice_are_dealt_once():
    batch = pa.RecordBatch.from_pydict({"doc_id": [7, None], "_key": [-5, 6]})
    high, low = np.array([3, 4, 3, 5, 3], np.uint64), np.array([1, 1, 1, 2, 1], np.uint64)
    out = repeats.dealt(batch, np.array([0, 0, 1, 1, 1]), np.arange(5), {"high": high.copy(), "low": low.copy()})
    assert out.column("doc_id").to_pylist() == [7, 7, None, None, None]
    assert out.column("place").to_pylist() == [0, 1, 2, 3, 4]
    keys = list(zip(out.column("high").to_pylist(), out.column("low").to_pylist()))
    n = out.column("n").to_pylist()
    assert keys[:2] == [(3, 1), (4, 1)] and len(set(keys)) == 5
    assert n[1] == 1 and n[0] == 2 and n[2] == 2


def test_texts_go_through_python_three_times(spark, monkeypatch):
    # Anchors, windows and kept words: anchors are not hashed again for their places.
    plans = []
    write = repeats.written
    monkeypatch.setattr(repeats, "written", lambda df: plans.append(df) or write(df))
    docs = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(60))) for i in range(3)], "doc_id long, text string")
    plans.append(repeats.remove(docs))
    assert sum(df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") for df in plans) == 3


def test_long_documents_and_many_copies(spark, monkeypatch):
    # Powers beyond those remembered, and rows that share id and text, are judged as any others.
    words = [f"w{i}" for i in range(300)]
    docs = spark.createDataFrame([(None, " ".join(words))] * 40 + [(5, " ".join([*words[100:150], "end"]))],
                                 "doc_id long, text string")
    want = sorted(map(str, repeats.remove(docs).collect()))
    monkeypatch.setattr(repeats, "POWERS", 16)
    assert sorted(map(str, repeats.remove(docs).collect())) == want
    assert sum("n_removed=300" in r for r in want) == 40 and sum("n_removed=50" in r for r in want) == 1
    rows = spark.createDataFrame([(None, 1, p) for p in (0, 63, 64, 200) * 50], "doc_id long, _key long, place int")
    row, = repeats._places(rows.repartition(3)).collect()
    assert sorted(64 * p.part + i for p in row.places for i in range(64) if p.mask >> i & 1) == [0, 63, 64, 200]
