"""Token counts of documents that are edited, without encoding them anew.

A document is cut into pre-tokens. Runs of ``LEAF`` pre-tokens are the leaves of a segment tree
whose nodes hold the characters and tokens below them. An edit finds its leaves by descending the
character sums, cuts the text of the touched pre-tokens and some context anew, stops where a new
cut meets an old one behind the edit, and updates the sums on the way to the root. The cut of a
text depends on what follows only, and looks at most two characters past a pre-token, so a few
characters before the edit are context enough.

Counts are those of a byte-level vocabulary with special tokens taken as ordinary text.

Documents and their edits meet in one sorted stream per partition; a task holds the document of one
id, however many edits it has.
Texts may be null (empty), empty or very long. Edits beyond the end of the text are moved to the
end, null starts and lengths count as 0 and null insertions as "". Edits of a document are applied
in the order of ``seq`` (ties: start, length, insertion). Edits of unknown documents are ignored.
Rows that share a ``doc_id`` are separate documents that get the same edits (a task holds them
together); null ids have none.
Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipstream.llm.bpe import Bpe, load, parts
from slipstream.llm.common import importable, text_key, with_names

# Pre-tokens of a leaf when the tree is built; a leaf that grows to eight times that is split.
LEAF = 64
# Characters before an edit that may be cut in another way because of it.
CONTEXT = 3

RESULT = "doc_id long, n_edits int, n_tokens_before long, n_tokens long, n_chars long, n_encoded long"


class Counter:
    """Tokens of pre-tokens, remembered."""

    def __init__(self, bpe: Bpe):
        self.bpe, self.encoded = bpe, 0

    def total(self, words: list[str]) -> int:
        self.encoded += len(words)
        try:
            return sum(map(len, map(self.bpe.known.__getitem__, words))) // 4
        except KeyError:
            return sum(map(len, map(self.bpe.remember(words).__getitem__, words))) // 4


class Document:
    """Leaves of pre-tokens under a segment tree of character and token sums."""

    def __init__(self, words: list[str], counter: Counter):
        self.counter = counter
        self._build([words[i:i + LEAF] for i in range(0, len(words), LEAF)] or [[]])

    def _build(self, leaves: list[list[str]], tokens: list[int] | None = None) -> None:
        self.leaves = leaves
        self.width = width = 1 << max(0, len(leaves) - 1).bit_length()
        empty = [0] * (width - len(leaves))
        self.chars = [0] * width + [sum(map(len, leaf)) for leaf in leaves] + empty
        self.tokens = [0] * width + (tokens or [self.counter.total(leaf) for leaf in leaves]) + empty
        for node in range(width - 1, 0, -1):
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(w for leaf in self.leaves for w in leaf)

    def _find(self, char: int) -> tuple[int, int]:
        """The leaf that holds a character (the last one for the end), and where the leaf starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            left = self.chars[node]
            if char >= start + left and self.chars[node + 1] > 0:
                node, start = node + 1, start + left
        return node - self.width, start

    def _set(self, leaf: int, words: list[str]) -> None:
        self.leaves[leaf] = words
        node = leaf + self.width
        chars = sum(map(len, words)) - self.chars[node]
        tokens = self.counter.total(words) - self.tokens[node]
        while node:
            self.chars[node] += chars
            self.tokens[node] += tokens
            node //= 2

    def edit(self, start: int, length: int, inserted: str) -> None:
        """Replace ``length`` characters from ``start`` by ``inserted``."""
        start = min(max(start, 0), self.n_chars)
        length = min(max(length, 0), self.n_chars - start)
        if not length and not inserted:
            return
        first, begin = self._find(max(0, start - CONTEXT))
        skipped, place = 0, begin
        words = self.leaves[first]
        while skipped < len(words) and place + len(words[skipped]) <= max(0, start - CONTEXT):
            place += len(words[skipped])
            skipped += 1
        last = self._find(start + length)[0]
        while True:
            # Text from the first pre-token that may change to the end of the last leaf.
            old = [w for leaf in self.leaves[first:last + 1] for w in leaf][skipped:]
            joined, offset = "".join(old), start - place
            text = joined[:offset] + inserted + joined[offset + length:]
            shift, ends, at = len(inserted) - length, set(), 0
            for w in old:
                at += len(w)
                if at >= offset + length:
                    ends.add(at + shift)
            new, at, met = [], 0, None
            whole = last == len(self.leaves) - 1
            for match in self.counter.bpe.scan(text):
                at = match.end()
                # The last cuts of an open text could change with what follows it.
                if not whole and at > len(text) - CONTEXT:
                    break
                new.append(match.group())
                if at in ends and at >= offset + len(inserted):
                    met = at
                    break
            if met is not None or whole:
                break
            last += 1
        kept, at = [], 0
        if met is not None:
            for w in old:
                if at >= met - shift:
                    kept.append(w)
                at += len(w)
        self._replace(first, last, self.leaves[first][:skipped] + new + kept)

    def _replace(self, first: int, last: int, words: list[str]) -> None:
        """New words for a run of leaves; the tree is built anew if a leaf becomes too large."""
        if len(words) > 8 * LEAF:
            parts = [words[i:i + LEAF] for i in range(0, len(words), LEAF)]
            tokens = self.tokens[self.width:self.width + len(self.leaves)]
            tokens[first:last + 1] = [self.counter.total(p) for p in parts]
            self._build([*self.leaves[:first], *parts, *self.leaves[last + 1:]], tokens)
            return
        self._set(first, words)
        for leaf in range(first + 1, last + 1):
            self._set(leaf, [])


def count(docs: DataFrame, edits: DataFrame, path: str) -> DataFrame:
    """Tokens of ``docs(doc_id, text)`` before and after ``edits(doc_id, seq, start, length, inserted)``.

    Starts and lengths count characters of the text as the earlier edits left it. ``n_encoded`` is
    the number of pre-tokens that were counted for the edits.
    """
    names = [f.split()[0] for f in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, held, now = Counter(load(path)), [], None

        def close() -> Iterator[pa.RecordBatch]:
            if held:
                rows = [(now, n, before, d.n_tokens, d.n_chars, encoded) for d, before, n, encoded in held]
                yield pa.RecordBatch.from_arrays([
                    pa.array(column, pa.int32() if name == "n_edits" else pa.int64())
                    for name, column in zip(names, zip(*rows))
                ], names)
            held.clear()

        for batch in (p for b in batches for p in parts(b, "text")):
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "_edit", "text", "start", "length")]
            # The words of all texts of a piece are encoded together.
            cut = [None if is_edit else counter.bpe.cut(t or "") for _, is_edit, t, *_ in zip(*columns)]
            counter.bpe.remember([w for words in cut if words for w in words])
            for words, name, is_edit, text, start, length in zip(cut, *columns):
                if name != now or name is None:
                    yield from close()
                    now = name
                if not is_edit:
                    document = Document(words, counter)
                    held.append([document, document.n_tokens, 0, 0])
                else:
                    for state in held:
                        encoded = counter.encoded
                        state[0].edit(start, length, text)
                        state[2] += 1
                        state[3] += counter.encoded - encoded
        yield from close()

    importable(docs.sparkSession)
    number = F.lit(0).cast("long")
    rows = with_names(docs, ["doc_id", "text"]).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(False).alias("_edit"), "text",
        number.alias("seq"), number.alias("start"), number.alias("length"),
        # Documents without an id share no task.
        F.coalesce(F.col("doc_id").cast("long"), text_key()).alias("_place"),
    )
    changes = with_names(edits, ["doc_id", "seq", "start", "length", "inserted"]).where("doc_id is not null")
    changes = changes.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("_edit"),
        F.coalesce("inserted", F.lit("")).alias("text"), F.col("seq").cast("long").alias("seq"),
        F.coalesce(F.col("start").cast("long"), number).alias("start"),
        F.coalesce(F.col("length").cast("long"), number).alias("length"),
        F.col("doc_id").cast("long").alias("_place"),
    )
    return rows.unionByName(changes).repartition("_place").sortWithinPartitions(
        "doc_id", "_edit", "seq", "start", "length", "text"
    ).select("doc_id", "_edit", "text", "start", "length").mapInArrow(run, RESULT)
