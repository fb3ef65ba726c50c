"""Removal of repeated passages, found through difference-cover anchors.

A window of ``WINDOW`` words is repeated if its word sequence starts at more than one place, in
any document. The residues ``COVER`` modulo ``PERIOD`` are a perfect difference cover: for any two
places there is a shift below the period that brings both to a cover place. So two equal windows
share an anchor, the words from a cover place that fit into the window whatever the shift
(``WINDOW - PERIOD + 1`` of them), and only those are hashed: 5 of 21 places.

1. Anchors of every document are hashed and dealt out by their hash, each with its place.
2. Those whose hash occurs once go. The others give the places in each document where a repeated
   window can lie: up to a period before a repeated anchor.
3. Whole windows are hashed (128 bits) at those starts only, dealt out by their hash and judged in
   the same way.
4. Words under repeated windows are taken out.

Nothing is compared in pairs. Python works on slices of many documents; of the equal hashes of a
slice only the first is dealt out by the hash, counting twice. The others are known to be repeated and
are dealt out by their place, so a passage that a third of all documents share puts one row per
slice and hash into a task. Places come back to their document as bits of 64 places each.

Documents are known by id and a hash of the text, so ids may repeat. Rows equal in both are copies:
their windows are repeated. Null ids are documents as any other. Null and empty texts have no
words. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slipstream.llm.common import importable, text_key, with_names, words_of, written

WINDOW, PERIOD = 35, 21
# A perfect difference set modulo 21.
COVER = (0, 1, 4, 14, 16)
# Python works on documents of about 16 bytes of text for each of so many rows, or one longer document.
BATCH_ROWS = 65_536
# Odd multipliers of the two rolling hashes.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
# Odd multipliers that mix the bytes of a word.
MIXERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
# So many powers of a base are remembered; longer documents have their own made.
POWERS = 1 << 20
# Words of more bytes are hashed one by one.
LONG_WORD = 64

SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


_first_powers = lru_cache(_powers)


def powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2 ** 64; only short lists are remembered."""
    return _first_powers(base, POWERS)[:n] if n <= POWERS else _powers(base, n)


def mixed(values: np.ndarray) -> np.ndarray:
    for factor, shift in zip(MIXERS, (29, 32)):
        values = values * np.uint64(factor)
        values ^= values >> np.uint64(shift)
    return values


class Words:
    """The words of several texts in one flat array, and their hashes."""

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("").cast(pa.large_string())
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = np.frombuffer(data or b"", np.uint8)[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        # Eight more bytes, so that eight can be read from every place.
        self.data = np.concatenate([data, np.zeros(8, np.uint8)])
        inside, edge = ~SPACE[data], np.ones(len(data) + 1, bool)
        np.logical_not(inside, out=edge[1:])
        edge[bounds] = True
        self.starts = np.flatnonzero(inside & edge[:-1])
        edge[:-1] = ~inside
        edge[bounds] = True
        self.sizes = np.flatnonzero(inside & edge[1:]) + 1 - self.starts
        # First word of each text, and one more.
        self.first = np.searchsorted(self.starts, bounds)
        self.counts = np.diff(self.first)
        self.of = np.repeat(np.arange(len(texts)), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word."""
        eight = np.ndarray(len(self.data) - 7, "<u8", self.data, strides=(1,))
        out, at, sizes = self.sizes.astype(np.uint64), np.arange(len(self.sizes)), self.sizes
        starts = self.starts
        for done in range(0, LONG_WORD, 8):
            # The first bytes are the low ones; those behind the word are shifted out.
            unused = np.maximum(8 - (sizes - done), 0).astype(np.uint64) << np.uint64(3)
            out[at] = mixed(out[at] ^ (eight[starts + done] << unused))
            more = sizes > done + 8
            if not more.any():
                break
            at, sizes, starts = at[more], sizes[more], starts[more]
        for i in np.flatnonzero(self.sizes > LONG_WORD):
            out[i] = xxhash.xxh3_64_intdigest(self.data[self.starts[i]:self.starts[i] + self.sizes[i]])
        return out

    def places(self) -> np.ndarray:
        """Place of each word in its text."""
        return np.arange(len(self.starts)) - np.repeat(self.first[:-1], self.counts)

    def fits(self, length: int) -> np.ndarray:
        """Whether so many words of the text begin at each word."""
        return np.arange(len(self.starts)) + length <= np.repeat(self.first[1:], self.counts)


def runs(hashes: np.ndarray, starts: np.ndarray, length: int, base: int) -> np.ndarray:
    """Hash of the ``length`` word hashes from each start."""
    # Sums of the hashes times rising powers, brought back to power 0.
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(base, len(hashes)), out=sums[1:])
    out = (sums[starts + length] - sums[starts]) * powers(pow(base, -1, 1 << 64), len(hashes))[starts]
    out ^= out >> np.uint64(32)
    return out * np.uint64(base)


def covered(starts: np.ndarray, ends: np.ndarray, n_words: int) -> np.ndarray:
    """Which words lie between a start and its end."""
    change = np.bincount(starts, minlength=n_words + 1) - np.bincount(ends, minlength=n_words + 1)
    return np.cumsum(change[:n_words]) > 0


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows that Python works on together."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // (16 * BATCH_ROWS)
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
    yield from (batch.slice(i, j - i) for i, j in zip(cuts, cuts[1:]) if j > i)


def marked_places(places: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of each bit that is set in ``places``."""
    parts = places.flatten()
    rows = np.repeat(np.arange(len(places)), pc.fill_null(pc.list_value_length(places), 0))
    masks = parts.field("mask").to_numpy(zero_copy_only=False).astype("<i8")
    part, bit = np.nonzero(np.unpackbits(masks.view(np.uint8), bitorder="little").reshape(-1, 64))
    return rows[part], parts.field("part").to_numpy(zero_copy_only=False).astype(np.int64)[part] * 64 + bit


def _integers(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def dealt(batch: pa.RecordBatch, rows: np.ndarray, places: np.ndarray, keys: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Places with their hashes ``keys`` and ``n``, how often these occur here, 2 at most.

    Behind the first of equal hashes the others get hashes of their own; they count 2. The rows stay
    in the order of the documents, whose names then take little room in the shuffle files.
    """
    order = np.argsort(next(iter(keys.values())), kind="stable")
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = np.logical_and.reduce([v[order[1:]] == v[order[:-1]] for v in keys.values()])
    n = np.ones(len(order), np.int8)
    n[order[same[:-1] | same[1:]]] = 2
    names, also = batch.column("doc_id").take(pa.array(rows)), batch.column("_key").take(pa.array(rows))
    others = order[same[:-1]]
    own = also.to_numpy()[others].view(np.uint64) + places[others].astype(np.uint64)
    for values in keys.values():
        own = mixed(own)
        values[others] = own
    return pa.RecordBatch.from_arrays(
        [names, also, pa.array(places, pa.int32()), pa.array(n), *map(_integers, keys.values())],
        ["doc_id", "_key", "place", "n", *keys],
    )


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(doc_id, _key, place) of the rows whose keys occur more than once."""
    often = F.sum("n").over(Window.partitionBy(*keys))
    return rows.withColumn("_often", often).where("_often > 1").select("doc_id", "_key", "place")


def _documents(docs: DataFrame) -> DataFrame:
    return with_names(docs, ["doc_id", "text"]).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("_key"), "text"
    )


def _places(rows: DataFrame) -> DataFrame:
    """(doc_id, _key, places): the places of ``rows(doc_id, _key, place)``, 64 in a part."""
    # Combined before the shuffle: rows that share id and text have the same places.
    parts = rows.groupBy("doc_id", "_key", F.shiftright("place", 6).alias("part")).agg(
        F.bit_or(F.expr("shiftleft(1L, place & 63)")).alias("mask")
    )
    return parts.groupBy("doc_id", "_key").agg(F.collect_list(F.struct("part", "mask")).alias("places"))


def _with_places(docs: DataFrame, places: DataFrame) -> DataFrame:
    """Documents with their ``places``, or null."""
    # Rows without an id are told apart by their text; they join on it alone.
    places = places.select(F.coalesce("doc_id", "_key").alias("_id"), F.col("_key").alias("_k"), "places")
    return docs.join(
        places, (F.coalesce("doc_id", "_key") == F.col("_id")) & (F.col("_key") == F.col("_k")), "left"
    ).drop("_id", "_k")


def remove(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, text): kept words of every document, joined by one space.

    ``window`` is 22 to 100 words; windows are judged on the input, not on what is left.
    """
    if not PERIOD < window <= 100:
        raise ValueError(f"window must be {PERIOD + 1} to 100 words")
    importable(docs.sparkSession)
    docs = _documents(docs)
    length = window - PERIOD + 1

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cover = np.isin(np.arange(PERIOD), COVER)
        for batch in batches:
            for rows in slices(batch):
                words = Words(rows.column("text"))
                places = words.places()
                starts = np.flatnonzero(cover[places % PERIOD] & words.fits(length))
                if len(starts):
                    yield dealt(rows, words.of[starts], places[starts], {
                        "anchor": runs(words.hashes(), starts, length, BASES[0])
                    })

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                words = Words(rows.column("text"))
                row, place = marked_places(rows.column("places"))
                first = words.first[row]
                near = covered(first + np.maximum(place - PERIOD + 1, 0), first + place + 1, len(words.starts))
                starts = np.flatnonzero(near & words.fits(window))
                if len(starts):
                    hashes = words.hashes()
                    high, low = (runs(hashes, starts, window, b) for b in BASES)
                    yield dealt(rows, words.of[starts], words.places()[starts], {"high": high, "low": low})

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                words = [words_of(text.as_py()) for text in rows.column("text")]
                sizes = np.array([len(w) for w in words], np.int64)
                first = np.cumsum(sizes) - sizes
                row, place = marked_places(rows.column("places"))
                out = covered(first[row] + place, first[row] + place + window, int(sizes.sum()))
                before = np.concatenate([[0], np.cumsum(out)])
                gone = before[first + sizes] - before[first]
                texts = [
                    b" ".join(compress(w, (~out[i:i + len(w)]).tolist()) if n else w)
                    for w, n, i in zip(words, gone.tolist(), first.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())],
                    ["doc_id", "n_words", "n_removed", "text"],
                )

    dealt_columns = "doc_id long, _key long, place int, n byte, "
    # Written by document: the table stays while the windows are counted, when the disk is fullest.
    likely = written(_places(_repeated(docs.mapInArrow(anchors, dealt_columns + "anchor long"), ["anchor"])))
    starts = written(_repeated(
        _with_places(docs, likely).where("places is not null")
        .mapInArrow(windows, dealt_columns + "high long, low long"), ["high", "low"],
    ))
    return _with_places(docs, _places(starts)).mapInArrow(
        kept, "doc_id long, n_words long, n_removed long, text string"
    )
