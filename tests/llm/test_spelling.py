"""Spelling variants against brute force, in small nodes too."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from slipstream.llm import spelling

UPPER = str.maketrans(spelling.UPPER, spelling.LOWER)


def near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def counted(rows) -> Counter:
    words = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            words[run] += 1
    return Counter({w: n for w, n in words.items() if len(w) >= 7 and n >= 2})


def by_brute_force(words: Counter) -> list[tuple]:
    # Words one edit apart share what is left without one character, or are it.
    groups = {}
    for w in words:
        for v in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            groups.setdefault(v, []).append(w)
    found = {w: set() for w in words}
    for group in groups.values():
        for a in group:
            found[a].update(b for b in group if b != a and near(a, b))
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(found[w]), words[form[w]] if form[w] else None))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    letters = "abcdeinrstéß÷"
    stems = ["".join(rng.choices(letters, k=rng.randrange(6, 11))) for _ in range(60)]
    stems += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "x" * 40, "x" * 41, "ab" * 3_000, "ab" * 3_000 + "c", "Ünd" * 4, "UNIFORM"]
    words = []
    for k, stem in enumerate(stems):
        words += [stem] * (1 + 40 * (k % 3)) * 2
        for _ in range(12):
            at = rng.randrange(len(stem) + 1)
            words += [stem[:at] + rng.choice(letters) + stem[at + rng.randrange(2):]] * rng.choice([1, 2, 5])
    words += ["chained"] * 6_000 + ["chainer"] * 400 + ["chaiter"] * 28 + ["chanter"] * 2
    rng.shuffle(words)
    texts = [" ".join(words[i:i + 50]) + "\n1st2nd" for i in range(0, len(words), 50)]
    return [*enumerate(texts), (7, texts[0]), (7, texts[0]), (None, texts[1]), (500, None), (501, ""), (502, "12 . ")]


@pytest.mark.parametrize("node", [4_096, 24])
def test_variants(spark, rows, monkeypatch, node):
    monkeypatch.setattr(spelling, "NODE", node)
    monkeypatch.setattr(spelling, "SEARCHES", 4 * node)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    found = spelling.variants(spelling.vocabulary(docs.repartition(5)))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = by_brute_force(counted(rows))
    assert sorted(map(tuple, found.collect())) == want
    assert any(r[1] and r[2] != r[1] for r in want) and any(len(r[0]) > 1_000 and r[4] for r in want)


def test_large_leaf(spark, monkeypatch):
    """Words of equal letter counts in one leaf of the trie, dealt to blocks."""
    monkeypatch.setattr(spelling, "NODE", 10)
    rng = random.Random(6)
    words = Counter({"".join(rng.sample("abcdein" * 2, 12)): rng.randrange(2, 90) for _ in range(150)})
    words.update({"ab" * 5 + "".join(rng.sample("abc", 3)): 4 for _ in range(8)})
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert sorted(map(tuple, spelling.variants(table).collect())) == by_brute_force(words)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.vocabulary(docs)).count() == 0


def test_query(spark, small):
    from slipstream.llm.queries import QUERIES

    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    want = by_brute_force(counted(map(tuple, docs.collect())))
    assert sorted(map(tuple, QUERIES["op12_spelling_variants"](spark, small).collect())) == want and len(want) > 100
