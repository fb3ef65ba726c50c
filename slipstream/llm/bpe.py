"""Byte-level BPE in batched numpy merge rounds.

Texts are cut into pre-tokens. Those not seen lately are encoded together: the symbols of many
words lie in one flat array, every round looks up all neighbouring pairs by binary search over the
sorted pair keys, takes the lowest rank of each word and merges its occurrences in all words at
once. A word takes part until none of its pairs has a rank.

Null and empty texts have no ids. Very long texts are worked through whole; a batch is cut by
bytes, so memory is bounded by one text or ``SLICE_BYTES``. Other columns pass through; a column
that has the name of the result is replaced.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from slipstream.llm.common import importable

# Fixed value of the vocabulary: how texts are cut into pre-tokens.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
SLICE_BYTES = 4 << 20
# Most pre-tokens whose ids a task remembers; beyond it the memory starts anew.
REMEMBERED = 200_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, to the byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bpe:
    """A vocabulary file: encodes lists of pre-tokens and texts, decodes ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocabulary = data["model"]["vocab"]
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.symbols = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.symbols[byte] = vocabulary[letter]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        self.base = max([*vocabulary.values(), *self.special.values()]) + 1
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        keys = left * self.base + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order, merged[order]
        self.bytes = [b""] * self.base
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.cut, self.scan = regex.compile(PATTERN).findall, regex.compile(PATTERN).finditer
        self.marks = regex.compile(
            "(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")"
        ) if self.special else None
        self.first, self.pairs = self.symbols.tolist(), None
        self.known: dict[str, bytes] = {}

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (the number of pairs if it has none), and the symbol it becomes."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], len(self.keys)), self.merged[at]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids, as bytes of 32-bit integers, of each pre-token, none of which may be empty."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = self.symbols[np.frombuffer(b"".join(raw), np.uint8)]
        word, none = np.repeat(np.arange(len(raw)), sizes), len(self.keys)
        last = np.r_[word[1:] != word[:-1], True]
        # rank[i] and into[i] belong to the pair of the symbols i and i + 1 of one word.
        rank, into = self._lookup(flat, np.r_[flat[1:], 0])
        rank[last] = none
        done_ids, done_words = [], []
        while len(flat):
            starts = np.flatnonzero(np.r_[True, last[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.r_[starts, len(flat)])
            active = lowest < none
            if not active.all():
                live = np.repeat(active, lengths)
                done_ids.append(flat[~live])
                done_words.append(word[~live])
                flat, word, last, rank, into = (x[live] for x in (flat, word, last, rank, into))
                lowest, lengths = lowest[active], lengths[active]
                if not len(flat):
                    break
            spots = np.flatnonzero(rank == np.repeat(lowest, lengths))
            # Equal pairs that overlap are a run of one symbol: every second of them merges.
            run = np.r_[True, np.diff(spots) > 1]
            if not run.all():
                first = np.maximum.accumulate(np.where(run, np.arange(len(spots)), 0))
                spots = spots[(np.arange(len(spots)) - first) % 2 == 0]
            flat[spots] = into[spots]
            last[spots] = last[spots + 1]
            keep = np.ones(len(flat), bool)
            keep[spots + 1] = False
            flat, word, last, rank, into = (x[keep] for x in (flat, word, last, rank, into))
            # Only pairs with a merged symbol have changed.
            spots = spots - np.arange(len(spots))
            changed = np.concatenate([spots, spots[spots > 0] - 1])
            changed = changed[~last[changed]]
            rank[spots[last[spots]]] = none
            rank[changed], into[changed] = self._lookup(flat[changed], flat[changed + 1])
        ids, owner = np.concatenate(done_ids).astype(np.int32), np.concatenate(done_words)
        data = ids[np.argsort(owner, kind="stable")].tobytes()
        ends = (4 * np.cumsum(np.bincount(owner, minlength=len(raw)))).tolist()
        return [data[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def encode_word(self, word: str) -> bytes:
        """Ids of one short pre-token; rounds over a single word need no arrays."""
        if self.pairs is None:
            self.pairs = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.merged.tolist())))
        ids = [self.first[b] for b in word.encode("utf-8", "surrogatepass")]
        while True:
            found = [self.pairs.get(a * self.base + b) for a, b in zip(ids, ids[1:])]
            best = min((f for f in found if f), default=None)
            if best is None:
                return np.array(ids, np.int32).tobytes()
            out, at = [], 0
            while at < len(ids):
                hit = at < len(found) and found[at] == best
                out.append(best[1] if hit else ids[at])
                at += 2 if hit else 1
            ids = out

    def remember(self, words: list[str]) -> dict[str, bytes]:
        """Ids, as bytes of 32-bit integers, of at least these pre-tokens."""
        missing = set(words).difference(self.known)
        if len(self.known) + len(missing) > REMEMBERED:
            self.known.clear()
            missing = set(words)
        if missing:
            new = list(missing)
            if len(new) < 32 and max(map(len, new)) < 64:
                self.known.update((w, self.encode_word(w)) for w in new)
            else:
                self.known.update(zip(new, self.encode_words(new)))
        return self.known

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text; the strings of special tokens stand alone."""
        if self.marks is None or not any(s in text for s in self.special):
            return self.cut(text)
        return [
            p for part in self.marks.split(text)
            for p in ([part] if part in self.special else self.cut(part))
        ]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes of 32-bit integers."""
        cut = [self.pieces(t) for t in texts]
        known = self.remember([w for words in cut for w in words if w not in self.special])
        special = {s: np.int32(i).tobytes() for s, i in self.special.items()}
        if any(s in t for t in texts for s in self.special):
            known = known | special
        return [b"".join(map(known.__getitem__, words)) for words in cut]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def slices(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of about ``SLICE_BYTES``, or one text."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > SLICE_BYTES:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def parts(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch that hold about ``SLICE_BYTES`` of a text or list column, or one row."""
    values = batch.column(column)
    text = pa.types.is_string(values.type) or pa.types.is_large_string(values.type)
    sizes = pc.binary_length(values) if text else pc.multiply(pc.list_value_length(values), 4)
    start, held = 0, 0
    for at, size in enumerate(pc.fill_null(sizes, 0).to_pylist()):
        if at > start and held + size > SLICE_BYTES:
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += size
    if batch.num_rows:
        yield batch.slice(start)


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], values], [*kept, name])


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text`` as a new array column; null texts give an empty array."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in (p for b in batches for p in parts(b, text)):
            coded = bpe.encode([t or "" for t in batch.column(text).to_pylist()])
            flat = np.frombuffer(b"".join(coded), np.int32)
            ends = np.cumsum([0, *[len(c) // 4 for c in coded]])
            yield _with_column(batch, ids, pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(flat, pa.int32())
            ))

    importable(docs.sparkSession)
    return docs.mapInArrow(run, _schema(docs, ids, T.ArrayType(T.IntegerType())))


def decode(coded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``coded`` with the text of ``ids`` as a new column; a null array gives null.

    Bytes that form no character are replaced as UTF-8 decoders do; an id that the vocabulary
    does not have raises an error.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in (p for b in batches for p in parts(b, ids)):
            column = batch.column(ids)
            values = column.flatten().to_numpy(zero_copy_only=False)
            if len(values) and values.min() < 0:
                raise ValueError("negative token id")
            out, at = [], 0
            for size in column.value_lengths().to_pylist():
                out.append(None if size is None else bpe.decode(values[at:at + size].tolist()))
                at += size or 0
            yield _with_column(batch, text, pa.array(out, pa.string()))

    importable(coded.sparkSession)
    return coded.mapInArrow(run, _schema(coded, text, T.StringType()))
