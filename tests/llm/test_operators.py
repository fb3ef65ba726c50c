"""The text operators against brute force, on odd rows: nulls, empty and long texts, repeated rows."""

from __future__ import annotations

import itertools
import random
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from slipstream.llm import bpe, decontam, lines, minhash, planes, repeats, shards, token_counts, toxicity, vectors
from slipstream.llm.components import components

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
DOCS = "doc_id long, text string, lang string, anchors int, words string, place string"
WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    base, other = prose(rng, 60), prose(rng, 200)
    edited = base.split()
    edited[30] = "other"
    found = [
        None, "", "   \n\t", "one", base, base, " ".join(edited), base.upper(), other + "\n" + base,
        "x" * 5_000, prose(rng, 20_000), "ÄÖ ü É́ \U0001F600 İ Σς <|endoftext|> a  b\r\nit's I'LL",
        other, "\n".join([other] * 3), "a line of some length 1\na line of some length 2\nshort\nshort",
    ] + [prose(rng, rng.randrange(1, 120)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(found)]
    return rows + [(None, base), (None, None), (4, base), (9, "another text under a used id")]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", 1, "x", None) for i, t in texts], DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_row(rows):
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 8), (7, 9), (5, 5), (None, 4), (3, 1), (100, 3)]
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 100: 1, 7: 7, 8: 7, 9: 7}
    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.component for r in components(chain).collect()} == {0}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bpe(docs, empty, texts):
    library = Tokenizer.from_file(BYTE)
    found = bpe.decode(bpe.encode(docs, BYTE), BYTE).collect()
    assert len(found) == len(texts) and found[0].lang == "en"
    for row in found:
        assert row.ids == library.encode(row.text or "", add_special_tokens=False).ids
        assert row.decoded == library.decode(row.ids, skip_special_tokens=False)
    assert bpe.encode(empty, BYTE).count() == 0


def test_bpe_rounds():
    rng, coder, library = random.Random(1), bpe.load(BYTE), Tokenizer.from_file(BYTE)
    words = ["".join(rng.choices("aab é1", k=rng.randrange(1, 40))) for _ in range(500)] + ["a" * 3_000]
    pieces = [p for w in words for p in coder.cut(w)]
    for piece, ids in zip(pieces, coder.encode_words(pieces)):
        assert ids == np.array(library.encode(piece, add_special_tokens=False).ids, np.int32).tobytes()
        if len(piece) < 64:
            assert ids == coder.encode_word(piece)


def test_planes(spark, docs, empty, texts, tmp_path):
    planes.write(docs, str(tmp_path / "ids"), WORD, end_id=2)
    found = planes.read(spark, str(tmp_path / "ids")).orderBy("start").collect()
    digests = planes.read_digests(spark, str(tmp_path / "ids")).orderBy("start").collect()
    library, at = Tokenizer.from_file(WORD), 0
    assert [r.doc_id for r in found][2:] == sorted(i for i, _ in texts if i is not None)
    known = {}
    for i, t in texts:
        known.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 2])
    for row, digest in zip(found, digests):
        assert row.ids in known[row.doc_id] and row.start == at == digest.start
        assert digest.ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())
        known[row.doc_id].remove(row.ids)
        at += len(row.ids)
    planes.write(empty, str(tmp_path / "none"), WORD)
    assert planes.read(spark, str(tmp_path / "none")).count() == 0
    for n in (0, 1, planes.BLOCK_IDS, planes.BLOCK_IDS * 2 + 5):
        ids = np.random.default_rng(n).integers(0, 1 << 32, n).astype("<u4")
        assert (planes.unpack(planes.pack(ids), n) == ids).all()


def test_shards(docs, empty, texts):
    found = shards.shuffle(docs, 4, seed=5).collect()
    assert by_row((r.doc_id, r.text) for r in found) == by_row(texts)
    for s in range(4):
        slots = sorted(r.slot for r in found if r.shard == s)
        assert slots == list(range(len(slots))) and len(slots) in (len(texts) // 4, -(-len(texts) // 4))
    assert shards.shuffle(empty, 4).count() == 0
    drawn = shards.matrix([5, 0, 7, 100], 8, 1)
    assert drawn.sum(1).tolist() == [5, 0, 7, 100] and set(drawn.sum(0)) == {14}


def test_edits_follow_full_count():
    rng, coder = random.Random(2), bpe.load(BYTE)
    text = lambda n: "".join(rng.choices("ab c'sre ll\n\n  12é,. ", k=n))
    for _ in range(300):
        now, counter = text(rng.choice([0, 1, 30, 900])), token_counts.Counter(coder)
        document = token_counts.Document(coder.cut(now), counter)
        for _ in range(6):
            start, length, new = rng.randrange(len(now) + 2), rng.choice([0, 1, 3, 400]), text(rng.choice([0, 1, 60, 700]))
            document.edit(start, length, new)
            start = min(start, len(now))
            now = now[:start] + new + now[start + length:]
            assert document.text() == now
            assert document.n_tokens == sum(len(x) // 4 for x in coder.encode([now]))


def test_token_counts(spark, docs, empty, texts):
    edits = spark.createDataFrame(
        [(4, 2, 3, 5, "xyz"), (4, 1, 0, 2, None), (3, 0, None, None, "q"), (10, 0, 70, 9, "new words"),
         (77_777, 0, 0, 1, "x"), (None, 0, 0, 1, "x"), (1, 0, 1 << 40, 3, "end")],
        "doc_id long, seq long, start long, length long, inserted string",
    )
    plain = Tokenizer.from_file(BYTE)
    plain.encode_special_tokens = True
    count = lambda t: len(plain.encode(t, add_special_tokens=False).ids)
    done = {4: lambda t: (lambda u: u[:3] + "xyz" + u[8:])(t[2:]), 3: lambda t: "q" + t,
            10: lambda t: t[:70] + "new words" + t[79:], 1: lambda t: t + "end"}
    want = by_row((i, count(t or ""), count(done.get(i, str)(t or ""))) for i, t in texts)
    found = token_counts.count(docs, edits, BYTE).collect()
    assert by_row((r.doc_id, r.n_tokens_before, r.n_tokens) for r in found) == want
    assert token_counts.count(empty, edits, BYTE).count() == 0


def test_repeats(docs, empty, texts):
    window = 25
    words = [repeats.words_of(t) for _, t in texts]
    places = {}
    for d, w in enumerate(words):
        for k in range(len(w) - window + 1):
            places.setdefault(tuple(w[k:k + window]), []).append((d, k))
    covered = [set() for _ in words]
    for found in places.values():
        for d, k in found if len(found) > 1 else []:
            covered[d].update(range(k, k + window))
    want = by_row(
        (i, len(w), len(c), " ".join(x.decode() for k, x in enumerate(w) if k not in c))
        for (i, _), w, c in zip(texts, words, covered)
    )
    assert by_row(map(tuple, repeats.remove(docs, window).collect())) == want
    assert repeats.remove(empty).count() == 0
    for a, b in itertools.product(range(repeats.PERIOD), repeat=2):
        assert any({(a + d) % repeats.PERIOD, (b + d) % repeats.PERIOD} <= set(repeats.COVER) for d in range(repeats.PERIOD))


def roots(nodes, links):
    """Smallest node reachable from each node."""
    at = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(at[a], at[b])
            changed |= at[a] != low or at[b] != low
            at[a] = at[b] = low
    return at


def family(rng, n, size, most):
    base = [rng.choice(WORDS) for _ in range(size)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(most)):
            copy[rng.randrange(size)] = rng.choice(WORDS)
        yield " ".join(copy)


@pytest.mark.parametrize(("size", "num", "least"), [(3, 85, 38), (5, 80, 34)])
def test_minhash(spark, texts, size, num, least, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = random.Random(size)
    rows = texts + [(1_000 + k, t) for k, t in enumerate(family(rng, 90, 70, 8))]
    rows += [(2_000 + k, t) for k, t in enumerate(family(rng, 40, 25, 4))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [(i, frozenset(minhash.shingles(t, size).tolist())) for i, t in rows if i is not None and t]
    sets = [(i, s) for i, s in sets if s]
    links = [(i, j) for (i, s), (j, t) in itertools.combinations(sets, 2)
             if i == j or 100 * len(s & t) >= num * len(s | t)]
    want = roots({i for i, _ in rows if i is not None}, links)
    found = minhash.near_duplicates(docs, size, num, 100, least).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row.component_id == want.get(row.doc_id)
        assert row.kept == (row.doc_id is None or row.doc_id == row.component_id)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("dense", "block"), [(256, 1_024), (2, 1_024), (2, 7)])
def test_vectors(spark, monkeypatch, dense, block):
    # Tasks get the small limits with the function, which is made on the driver.
    monkeypatch.setattr(vectors, "DENSE", dense)
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 16)))]
    near = [(100 + i, (rng.normal(size=16) * 0.02 + np.ones(16)).tolist()) for i in range(40)]
    near += [(140 + i, (rng.normal(size=16) * 0.2 + np.ones(16)).tolist()) for i in range(40)]
    odd = [(200, None), (201, [0.0] * 16), (202, [float("nan")] * 16), (203, [float("inf")] + [1.0] * 15),
           (204, [None] + [1.0] * 15), (205, [1.0] * 3), (206, []), (None, [1.0] * 16), (207, [1e-200] * 16)]
    same = [(300, rows[5][1]), (301, rows[5][1]), (301, rows[7][1])]
    every = rows + near + odd + same
    good = [(i, np.array(v, float)) for i, v in every if i is not None and i not in range(200, 207)]
    unit = [(i, v / np.abs(v).max()) for i, v in good]
    unit = [(i, v / np.linalg.norm(v)) for i, v in unit]
    links = [(i, j) for (i, v), (j, w) in itertools.combinations(unit, 2) if v @ w >= 0.95]
    want = roots({i for i, _ in every if i is not None}, links)
    frame = spark.createDataFrame(every, "vec_id long, embedding array<double>")
    for row in vectors.link(frame, 16).collect():
        assert row.component_id == want.get(row.vec_id)
        assert row.n_links == sum((i == row.vec_id) + (j == row.vec_id) for i, j in links)
    assert vectors.link(frame.limit(0), 16).count() == 0


def test_masks_fit_any_substitutions():
    for gone in itertools.combinations(range(decontam.WINDOW), decontam.SUBSTITUTED):
        assert any(
            not {o + m for m in mask} & set(gone)
            for mask in decontam.MASKS for o in range(decontam.WINDOW - mask[-1])
        )


def test_decontamination(spark, docs, empty, texts):
    rng = random.Random(8)
    items = [prose(rng, n) for n in (14, 30, 5, 13)] + [None, "", texts[12][1][:200], "only four words here", prose(rng, 9)]
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)], "item_id long, text string, seed int")

    def leak(text, places):
        words = text.split()
        for p in places:
            words[p] = "changed"
        return " ".join(words)

    extra = [(500, "a b " + leak(items[1], [3, 9, 17, 25]) + " c"), (501, leak(items[0], [0, 13])),
             (502, leak(items[3], [5, 6, 7])), (503, leak(items[3], [2, 8])),
             (504, "x " + items[2].upper() + " y"), (505, leak(items[2], [4])), (506, items[4 + 3]), (507, items[8] + " " + items[2] + " " + items[8])]
    rows = texts + extra
    frame = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    theirs = [(t or "").lower().split() for t in items]
    w, want = decontam.WINDOW, []
    for i, t in rows:
        words, over = (t or "").lower().split(), set()
        for k in range(len(words) - w + 1):
            if any(sum(a == b for a, b in zip(words[k:k + w], it[q:q + w])) >= w - decontam.SUBSTITUTED
                   for it in theirs for q in range(len(it) - w + 1)):
                over.update(range(k, k + w))
        for it in (x for x in theirs if decontam.SHORTEST <= len(x) < w):
            for k in range(len(words) - len(it) + 1):
                if words[k:k + len(it)] == it:
                    over.update(range(k, k + len(it)))
        want.append((i, len(over), bool(over)))
    assert by_row(map(tuple, decontam.mark(frame, bench).collect())) == by_row(want)
    assert {i for i, _, hit in want if hit} >= {500, 501, 503, 504, 507} and (502, 0, False) in want
    assert {(505, 0, False), (506, 0, False), (504, 5, True)} <= set(want)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([r for r in rows if r[0] is not None and r[0] >= 500], columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame([(i, t) for i, t in enumerate(items)], columns=["item_id", "text"]))
    by_sql = con.execute("with " + decontam.OVERLAP_SQL.format(docs="documents") + " select doc_id, n from _over").fetchall()
    assert sorted(by_sql) == sorted((i, n) for i, n, hit in want if hit and i is not None and i >= 500)
    left = decontam.remove(frame, bench).count()
    assert left == sum(not hit for *_, hit in want)
    assert decontam.mark(empty, bench).count() == 0
    assert decontam.remove(frame, bench.limit(0)).count() == len(rows)


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    return a == b or any(
        a[:k] + a[k + 1:] in (b, b[:k] + b[k + 1:]) or b[:k] + b[k + 1:] == a for k in range(max(len(a), len(b)))
    )


def test_lines(spark, docs, empty, texts):
    rng = random.Random(4)

    def altered(line):
        k = rng.randrange(len(line))
        return rng.choice([line[:k] + "#" + line[k:], line[:k] + "#" + line[k + 1:], line[:k] + line[k + 1:]])

    pool = [prose(rng, n) for n in (4, 5, 8, 30, 200, 900)] + ["a" * 20, "ab" * 30]
    pool += [altered(x) for x in pool for _ in range(4)]
    extra = [(600 + k, "\n".join(rng.choices([*pool, "", "brief", "  " + pool[2] + " \t"], k=6))) for k in range(25)]
    rows = texts + extra
    white = " \t\r\x0b\x0c"
    frame = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    keys = {(r.doc_id, r.text): r.k for r in frame.select("doc_id", "text", lines.text_key().alias("k")).collect()}
    first = {}
    for (i, t), key in keys.items():
        for k, line in enumerate((t or "").split("\n") if t is not None else []):
            line = line.strip(white)
            place = (i is not None, i or 0, key, k)
            if line:
                first[line] = min(first.get(line, place), place)
    long = {a: p for a, p in first.items() if len(a) >= lines.LEAST}
    near = {a for a, p in long.items() if any(q < p and within_one(a, b) for b, q in long.items())}
    want = []
    for i, t in rows:
        split = [] if t is None else t.split("\n")
        kept = [x for k, x in enumerate(split) if not x.strip(white) or (
            x.strip(white) not in near and first[x.strip(white)] == (i is not None, i or 0, keys[i, t], k))]
        want.append((i, None if t is None else "\n".join(kept), len(split), len(split) - len(kept)))
    assert near
    assert by_row(map(tuple, lines.deduplicate(frame).collect())) == by_row(want)
    assert lines.deduplicate(empty).count() == 0


def test_toxicity(spark, docs, empty):
    rng = random.Random(6)
    rows = [(i, prose(rng, 60) + (" vile nasty, vile horrid" if i % 6 == 0 else "")) for i in range(1_200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, int(i % 6 == 0)) for i, _ in rows if i % 5 < 3] + [(None, 1), (3, None), (10**9, 1)],
        "doc_id long, toxic int",
    )
    model = toxicity.train(frame, labels)
    found = toxicity.score(frame.withColumn("held", toxicity.held_out()), model).where("held").collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    hits = [r.predicted == int(r.doc_id % 6 == 0) for r in found]
    assert sum(hits) / len(hits) > 0.97
    odd = toxicity.score(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.score(empty, model).count() == 0
    none = toxicity.train(frame, labels.where("toxic = 0"))
    assert toxicity.score(frame, none).agg(F.max("predicted")).first()[0] == 0
