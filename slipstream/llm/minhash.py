"""Near-duplicate documents through an inverted join of MinHash signatures.

A document's set are its distinct shingles. Its signature has ``COORDINATES`` minima of hash
functions; two sets agree in a coordinate with the probability of their Jaccard similarity. Every
document is posted under *keys*: two coordinates next to each other, with both their values, so
that single shingles that many texts have in common make no key. Pairs that agree in at least
``least`` coordinates differ in at most ``COORDINATES - least`` pairs of coordinates, and so share
one of the first ``COORDINATES - least + 1`` keys; only this prefix is posted. Collisions of those
that meet are counted on sketches, one byte per coordinate, which count at least as many as there
are. All links are confirmed on the full sets.

1. Documents with equal sets become one class; only one document of a class goes on.
2. Keys with one class go. In each other key the class that shares most keys with others is the
   *pivot*. Every class meets the pivots of its keys, which is linear in the postings. Long lists
   are skipped that way: they are not merged in pairs. Collisions with the pivot are counted, and
   pairs with too few for step 3 go before texts are compared.
3. Documents within three times the Jaccard distance of a link from a pivot are that pivot's
   group. What a member lacks or has besides the pivot's set is its difference, and two members'
   similarity follows exactly from their differences. A member that is not linked to its pivot can
   be linked only to members whose difference shares an element with its own, so the unlinked ones
   are held against the group, in blocks, on the elements that occur twice.
   The group that counts for a member is the largest one it is in, so that a cluster with many pivots is one group.
4. Documents within twice that distance are done: by the triangle inequality all they can be linked
   to is in the group. Others stay in their keys. Blocks of the remaining postings count collisions,
   and what agrees in ``least`` coordinates is compared on full sets.

A pair at the threshold is missed if it agrees in fewer than ``least`` coordinates, or if one of
the two, at the edge of the group of step 3, collides with the pivot less often than the mean less
five standard deviations. The first has a probability of 1.5e-7 for 0.85 (``least`` 38) and 3.2e-7
for 0.80 (``least`` 34), the second of 6.5e-8 and 7.2e-9; nearer pairs are missed less.

``doc_id`` names documents: rows that share an id are linked to each other, and their texts count
as copies of one node. Rows without an id link with nothing. Null and empty texts have an empty set
and link with nothing; equal sets are linked, whatever the texts. Other columns are left out, and
an empty table gives an empty result. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.llm.common import importable, pairs_within, semi_join, whole_groups, with_names, words_of, written
from slipstream.llm.components import components, spanning

COORDINATES, SEED = 64, 11
# Most rows of one key or pivot that a task holds of each side.
BLOCK = 1_024
# Odd multipliers of the shingle hash.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0x27D4EB2F165667C5)


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a shorter text is one shingle of all its words."""
    words = [w.lower() for w in words_of(text)]
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b"\0".join(words))], np.uint64)
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(FACTORS[i % len(FACTORS)]) + hashes[i:i + n]
    out ^= out >> np.uint64(32)
    out *= np.uint64(FACTORS[0])
    return np.unique(out ^ (out >> np.uint64(31)))


def signature(found: np.ndarray) -> np.ndarray:
    """Minima of the set under ``COORDINATES`` hash functions, as 32-bit integers."""
    factors = np.random.default_rng(SEED).integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
    factors = factors * np.uint64(2) + np.uint64(1)
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2_048):
        least = np.minimum(least, (found[at:at + 2_048, None] * factors).min(0))
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def posted_under(sig: np.ndarray, keys: int) -> np.ndarray:
    """The first ``keys`` keys of a signature: the number of the pair above 56 bits of its values."""
    pairs = sig.view(np.uint32).astype(np.uint64).reshape(-1, 2)[:keys]
    mixed = (pairs[:, 0] * np.uint64(FACTORS[0]) + pairs[:, 1]) * np.uint64(FACTORS[1])
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(FACTORS[2])
    number = np.arange(len(pairs), dtype=np.uint64) << np.uint64(56)
    return ((mixed >> np.uint64(8)) | number).astype(np.int64)


def sketch(sig: np.ndarray) -> np.ndarray:
    """One byte per coordinate: equal values have equal bytes."""
    return ((sig.view(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def _profiles(docs: DataFrame, size: int, prefix: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, highs, lows, keys, sketches = [], [], [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py(), size)
                mark = xxhash.xxh3_128_intdigest(found.tobytes())
                sig = signature(found)
                sizes.append(len(found))
                highs.append((mark >> 64) - (1 << 63))
                lows.append((mark & ((1 << 64) - 1)) - (1 << 63))
                keys.append(posted_under(sig, prefix) if len(found) else None)
                sketches.append(sketch(sig).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(highs, pa.int64()),
                pa.array(lows, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary()),
            ], ["doc_id", "n", "high", "low", "keys", "sketch"])

    return docs.mapInArrow(run, "doc_id long, n long, high long, low long, keys array<bigint>, sketch binary")


def _sketches(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.uint8).reshape(-1, COORDINATES)


def _colliding(pairs: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b) of (a, b, sketch_a, sketch_b) that collide in at least ``least`` coordinates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (_sketches(batch.column(c).to_pylist()) for c in ("sketch_a", "sketch_b"))
            keep = pa.array((x == y).sum(1) >= least)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"]
            )

    return pairs.select("a", "b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def _compared(pairs: DataFrame, texts: DataFrame, size: int, group: float) -> DataFrame:
    """Pairs (a, b) with exact counts, and the difference of a from b where they are similar."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, other = None, None
        for batch in batches:
            rows = []
            for a, b, x, y in zip(*(batch.column(c) for c in ("a", "b", "text_a", "text_b"))):
                if y != held:
                    held, other = y, shingles(y.as_py(), size)
                own = shingles(x.as_py(), size)
                common = len(np.intersect1d(own, other, assume_unique=True))
                near = common >= group * (len(own) + len(other) - common) - 1e-9
                rows.append((
                    a.as_py(), b.as_py(), len(own), len(other), common,
                    np.setxor1d(own, other, assume_unique=True).tobytes() if near else None,
                ))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], pa.binary() if i == 5 else pa.int64()) for i in range(6)],
                ["a", "b", "n_a", "n_b", "common", "difference"],
            )

    texts = written(semi_join(texts, pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")), "doc_id"))
    left = texts.withColumnsRenamed({"doc_id": "a", "text": "text_a"})
    right = texts.withColumnsRenamed({"doc_id": "b", "text": "text_b"})
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(
        run, "a long, b long, n_a long, n_b long, common long, difference binary"
    )


def _blocks(rows: DataFrame, key: str, counted: DataFrame) -> DataFrame:
    """Rows sent to every pair of blocks of their key: own block, and the pair i <= j."""
    rows = rows.join(counted, key).withColumn("own", F.pmod(F.xxhash64("a"), "blocks").cast("int"))
    return rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"i": F.least("own", "other"), "j": F.greatest("own", "other")}
    ).drop("other", "blocks")


def _group_links(near: DataFrame, num: int, den: int) -> DataFrame:
    """Links of members that are not linked to their pivot, within the pivot's group."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        i, j = int(key[1]), int(key[2])
        rows = rows.reset_index(drop=True)
        parts = [np.frombuffer(d, np.uint64) for d in rows["difference"]]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        element, seen = np.unique(np.concatenate(parts), return_inverse=True)
        often = np.flatnonzero(np.bincount(seen, minlength=len(element)) > 1)
        owner = np.repeat(np.arange(len(parts)), sizes)
        own = rows["own"].to_numpy()
        free = ~rows["linked"].to_numpy(bool)
        n = rows["n_a"].to_numpy()
        left, right = np.flatnonzero((own == i)), np.flatnonzero((own == j))
        out = []
        for x, y in ((left[free[left]], right), (right[free[right]], left))[: 1 if i == j else 2]:
            if not len(x) or not len(y):
                continue
            both = np.zeros((len(x), len(y)), np.float32)
            at_x, at_y = np.full(len(parts), -1), np.full(len(parts), -1)
            at_x[x], at_y[y] = np.arange(len(x)), np.arange(len(y))
            for lo in range(0, len(often), 4_096):
                part = often[lo:lo + 4_096]
                column = np.full(len(element), -1)
                column[part] = np.arange(len(part))
                used = column[seen] >= 0
                matrices = []
                for at, count in ((at_x, len(x)), (at_y, len(y))):
                    mine = used & (at[owner] >= 0)
                    m = np.zeros((count, len(part)), np.float32)
                    m[at[owner[mine]], column[seen[mine]]] = 1
                    matrices.append(m)
                both += matrices[0] @ matrices[1].T
            apart = sizes[x][:, None] + sizes[y][None, :] - 2 * both
            total = n[x][:, None] + n[y][None, :]
            # common = (total - apart) / 2, union = (total + apart) / 2
            hit = den * (total - apart) >= num * (total + apart)
            p, q = np.nonzero(hit)
            out.append((x[p], y[q]))
        p, q = (np.concatenate([np.empty(0, np.int64), *x]) for x in (zip(*out) if out else ([], [])))
        return pd.DataFrame(dict(zip("ab", spanning(rows["a"].to_numpy(), p, q))))

    # Groups without an unlinked member need no further look.
    counted = near.groupBy("b").agg(
        F.count("*").alias("n_rows"), F.max((~F.col("linked")).cast("int")).alias("open")
    ).where("open = 1 and n_rows > 1").select("b", F.ceil(F.col("n_rows") / BLOCK).cast("int").alias("blocks"))
    return _blocks(near.select("b", "a", "n_a", "linked", "difference"), "b", counted).groupBy(
        "b", "i", "j"
    ).applyInPandas(run, "a long, b long")


def _key_pairs(postings: DataFrame, least: int, num: int, den: int) -> DataFrame:
    """Pairs of the remaining postings that collide in ``least`` coordinates.

    Left out are pairs of one component, and those that were compared in the group of one pivot.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, ["key", "i", "j"]):
            own, n, label, home, name = (rows[c].to_numpy() for c in ("own", "n", "label", "home", "a"))
            across = (rows["i"] != rows["j"]).to_numpy()
            known = _sketches(rows["sketch"].tolist())
            for p, q in pairs_within(rows, ["key", "i", "j"]):
                may = (
                    (~across[p] | (own[p] != own[q])) & (label[p] != label[q]) & (home[p] != home[q])
                    & (np.minimum(n[p], n[q]) * den >= np.maximum(n[p], n[q]) * num)
                )
                p, q = p[may], q[may]
                keep = (known[p] == known[q]).sum(1) >= least
                if keep.any():
                    a, b = name[p[keep]], name[q[keep]]
                    yield pd.DataFrame({"a": np.maximum(a, b), "b": np.minimum(a, b)}).drop_duplicates()

    counted = postings.groupBy("key").agg(
        F.count("*").alias("n_rows"), F.min("label").alias("low"), F.max("label").alias("high")
    ).where("low <> high").select("key", F.ceil(F.col("n_rows") / BLOCK).cast("int").alias("blocks"))
    return _blocks(postings, "key", written(counted)).repartition("key", "i", "j").sortWithinPartitions(
        "key", "i", "j"
    ).mapInPandas(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, least: int = 34
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for ``docs(doc_id, text)``.

    Linked are documents whose sets of ``size``-word shingles have an intersection of at least
    num / den of their union; ``component_id`` is the smallest doc_id reachable.
    """
    importable(docs.sparkSession)
    # Jaccard distances up to 2 and 3 times that of a link are near a pivot and in its group.
    near, group = max(0.0, 2 * num / den - 1), max(0.05, 3 * num / den - 2)
    agree = int(COORDINATES * group - 5 * (COORDINATES * group * (1 - group)) ** 0.5)
    linked = F.col("common") * den >= (F.col("n_a") + F.col("n_b") - F.col("common")) * num
    named = with_names(docs, ["doc_id", "text"]).withColumn("doc_id", F.col("doc_id").cast("long"))
    profiles = written(_profiles(named, size, min(COORDINATES // 2, COORDINATES - least + 1)))
    usable = profiles.where("doc_id is not null and n > 0")
    ids = written(usable.groupBy("high", "low").agg(F.min("doc_id").alias("a")))
    classes = written(
        usable.join(ids, ["high", "low"]).where("doc_id = a").select("a", "n", "keys", "sketch").distinct()
    )
    # Counts and pivots are written before they are joined: by size, and hot keys can be split.
    posted = classes.select("a", F.explode("keys").alias("key"))
    counts = written(posted.groupBy("key").agg(F.count("*").alias("n_key")).where("n_key > 1"))
    postings = written(posted.join(counts, "key"))
    # The class that shares most keys, counted by their sizes, is the most central one.
    shared = postings.groupBy("a").agg(F.sum("n_key").alias("shared"))
    pivots = written(postings.join(shared, "a").groupBy("key").agg(
        F.max(F.struct("shared", "a")).alias("x")
    ).select("key", F.col("x.a").alias("b")))
    assigned = written(postings.join(pivots, "key").where("a <> b").select("key", "a", "b"))
    signed = classes.select("a", F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    other = classes.select(F.col("a").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    stars = assigned.select("a", "b").distinct().join(signed, "a").join(other, "b").where(
        F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * F.lit(group)
    )
    texts = named.where("doc_id is not null")
    compared = written(_compared(written(_colliding(stars, agree)), texts, size, group))
    in_group = compared.where("difference is not null").withColumn("linked", linked)
    links = compared.where(linked).select("a", "b").union(written(_group_links(in_group, num, den)))
    known = components(links)
    similarity = F.col("common") / (F.col("n_a") + F.col("n_b") - F.col("common"))
    # The pivot with the largest group is the home: a cluster that has many pivots gets one home.
    members = written(in_group.groupBy("b").agg(F.count("*").alias("members")))
    homes = in_group.select("a", "b").join(members, "b").groupBy("a").agg(
        F.max(F.struct("members", "b")).alias("x")
    ).select("a", F.col("x.b").alias("home"))
    close = in_group.where(similarity >= near).select("a", "b").distinct()
    far = assigned.join(close, ["a", "b"], "left_anti").select("key", "a").join(
        classes.select("a", "n", "sketch"), "a"
    )
    left = written(
        far.join(known.withColumnRenamed("id", "a"), "a", "left").join(homes, "a", "left").select(
            "key", "a", "n", "sketch", F.coalesce("component", "a").alias("label"),
            F.coalesce("home", "a").alias("home"),
        )
    )
    rest = written(_key_pairs(left, least, num, den))
    more = written(_compared(rest, texts, size, 2.0)).where(linked).select("a", "b")
    labels = components(links.union(more))
    joined = profiles.join(ids, ["high", "low"], "left").join(
        labels.withColumnRenamed("id", "a"), "a", "left"
    )
    root = F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.coalesce("component", "a"))
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce(root, "doc_id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
