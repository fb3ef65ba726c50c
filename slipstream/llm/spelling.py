"""Groups of spelling variants, by a trie over letter counts.

Words one edit apart (a code point inserted, deleted or replaced) have nearly equal letter counts:
with letters dealt to groups, one group may have one letter more and one group one letter less.
Words are arranged in a trie whose level ``i`` branches by the number of letters of group ``i``.
From a word, a depth-first search takes at every level the same count, or one more if the surplus
is not spent, or one less if the deficit is not spent. Words in the leaves it reaches are verified.
Of two words with different counts one finds the other: the deficit may be spent only after the
surplus, and what is found holds both ways.

1. Runs of letters are counted: one partial-and-final aggregation, words of the wrong length or
   seen too rarely go.
2. The trie is made from the top, a level at a time, by counting words per node. A node with at
   most ``NODE`` words is a home: its whole subtree goes to one task. Larger nodes get another
   level. A last-level node that is still larger is dealt to blocks.
3. The search starts as a table of (word, node, what is left of the budget) and is joined with the
   nodes of each level; a search goes on below large nodes and waits at homes.
4. Each task builds the lower levels of its home as sorted arrays of prefixes, and all searches
   that wait there go on through them, a batch at a time. Its words are at most ``NODE``; searches
   are streamed and not held. Where more than ``SEARCHES`` wait, copies of the home share them.
5. What leaves a task are counts and the best near word per word and batch, not pairs.

Counts are kept in ``BITS`` bits a level; larger ones count as the largest, which can only let more
through to the verification. Results do not depend on groups, ``NODE`` or the partitioning.

Null and empty texts have no words; a null id counts as an empty text where ids matter; texts are
read whole and words have no maximal length. Repeated rows count as often as they occur. Ties go to
the word first in code-point order. Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream.llm.common import importable, with_names, written

LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Letters of a group; all others are dealt by their code point.
GROUPS = ("e", "a", "i", "n", "r", "t", "o", "s", "lz", "uq", "dj", "cx", "mkf", "pvb", "ghwy")
BITS = 4
NODE, SEARCHES = 4_096, 16_384
# Most cells of a table of characters, and most candidates, that a task verifies at once.
CELLS = 1 << 21

_LEVELS = len(GROUPS)
_MOST = (1 << BITS) - 1
_GROUP_OF = np.arange(256) % _LEVELS
for _number, _letters in enumerate(GROUPS):
    for _letter in _letters:
        _GROUP_OF[ord(_letter)] = _number


def damaged(run: Column, doc_id: Column, every: int) -> Column:
    """``run`` without one code point if ``every`` divides the checksum of id and run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))
    return F.when(h % every == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, shortest: int = 7, least: int = 2, every: int = 31) -> DataFrame:
    """(word, n) of the words of ``docs(doc_id, text)``: lower-cased runs of letters, some damaged."""
    runs = with_names(docs, ["doc_id", "text"]).select(
        "doc_id", F.explode(F.expr(f"regexp_extract_all(text, '{LETTERS}', 0)")).alias("run")
    ).where(F.length("run") >= shortest)
    lower = F.translate("run", UPPER, LOWER)
    return runs.select(damaged(lower, F.col("doc_id"), every).alias("word")).where(
        F.length("word") >= shortest
    ).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def trie_code(words: list[bytes]) -> np.ndarray:
    """Counts per group of every word, ``BITS`` bits a level, the first level highest."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    flat = _GROUP_OF[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), size)
    counts = np.minimum(np.bincount(owner * _LEVELS + flat, minlength=len(words) * _LEVELS), _MOST)
    code = np.zeros(len(words), np.int64)
    for level in counts.reshape(-1, _LEVELS).T:
        code = (code << BITS) | level
    return code


def one_edit(
    flat: np.ndarray, start: np.ndarray, size: np.ndarray, p: np.ndarray, q: np.ndarray
) -> np.ndarray:
    """Whether words p and q (their places in a flat array of characters) are one edit apart."""
    out = np.zeros(len(p), bool)
    short = np.where(size[p] <= size[q], p, q)
    long = p + q - short
    may = np.flatnonzero(size[long] - size[short] <= 1)
    may = may[np.argsort(size[long[may]], kind="stable")]
    at = 0
    while at < len(may):
        # Words of like length together, so that the table holds little but characters.
        few = max(1, CELLS // max(1, int(size[long[may[at]]])))
        part = may[at:at + few]
        width = int(size[long[part[-1]]])
        if width > 2 * size[long[part[0]]] + 8:
            part = part[size[long[part]] <= 2 * size[long[part[0]]] + 8]
            width = int(size[long[part[-1]]])
        if len(part) * width > 4 * CELLS:
            part = part[:max(1, 4 * CELLS // width)]
        a, b = short[part], long[part]
        step = np.arange(width)
        inside = step < size[a][:, None]
        last = len(flat) - 1
        one = flat[np.minimum(start[a][:, None] + step, last)]
        two = flat[np.minimum(start[b][:, None] + step, last)]
        apart = (one != two) & inside
        same_size = size[a] == size[b]
        front = np.where(apart.any(1), apart.argmax(1), size[a])
        one = flat[np.maximum((start + size)[a][:, None] - 1 - step, 0)]
        two = flat[np.maximum((start + size)[b][:, None] - 1 - step, 0)]
        behind = (one != two) & inside
        back = np.where(behind.any(1), behind.argmax(1), size[a])
        out[part] = np.where(same_size, apart.sum(1) == 1, front + back >= size[a])
        at += len(part)
    return out


def _nodes(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Words with their home node, and the searches that wait at each home.

    Both are (level, prefix, block, word, n, code, more, less); a node is (level, prefix), and
    ``more`` and ``less`` are what a search has left to spend.
    """
    homes, waiting = [], []
    inside = words
    search = words.withColumns({"prefix": F.lit(0).cast("long"), "more": F.lit(True), "less": F.lit(True)})
    for level in range(1, _LEVELS + 1):
        inside = inside.withColumn("prefix", F.shiftright("code", BITS * (_LEVELS - level)))
        last = level == _LEVELS
        nodes = written(inside.groupBy("prefix").agg(F.count("*").alias("size"))).select(
            "prefix", (F.lit(False) if last else F.col("size") > NODE).alias("large"),
            F.ceil(F.col("size") / NODE).cast("int").alias("blocks"),
        )
        own = (F.shiftright("code", BITS * (_LEVELS - level)) % (1 << BITS)).cast("int")
        search = search.withColumn("step", F.explode(F.array(F.lit(0), F.lit(1), F.lit(-1)))).where(
            (F.col("step") == 0) | ((F.col("step") == 1) & F.col("more"))
            | ((F.col("step") == -1) & F.col("less") & ~F.col("more"))
        ).withColumn("child", own + F.col("step")).where(F.col("child").between(0, _MOST)).select(
            "word", "n", "code", (F.col("prefix") * (1 << BITS) + F.col("child")).alias("prefix"),
            (F.col("more") & (F.col("step") != 1)).alias("more"),
            (F.col("less") & (F.col("step") != -1)).alias("less"),
        ).join(nodes, "prefix")
        inside = inside.join(nodes, "prefix")
        columns = [F.lit(level).alias("level"), "prefix", "block", "word", "n", "code", "more", "less"]
        homes.append(inside.where("not large").withColumns({
            "block": F.pmod(F.xxhash64("word"), "blocks").cast("int"), "more": F.lit(False), "less": F.lit(False),
        }).select(*columns))
        # A search looks at every block of a home.
        waiting.append(search.where("not large").withColumn(
            "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        ).select(*columns))
        if last:
            break
        inside = written(inside.where("large").select("word", "n", "code"))
        if inside.isEmpty():
            break
        search = written(search.where("large").select("word", "n", "code", "prefix", "more", "less"))
    return reduce(DataFrame.union, homes), reduce(DataFrame.union, waiting)


class _Home:
    """Words of one node, with the levels below it as sorted arrays of prefixes."""

    def __init__(self, rows: pd.DataFrame):
        code = rows["code"].to_numpy()
        order = np.argsort(code, kind="stable")
        self.code, self.n = code[order], rows["n"].to_numpy()[order]
        names = rows["word"].to_numpy(object)
        self.names = [names[i] for i in order]
        self.level = int(rows["level"].iat[0])
        self.levels = {
            at: np.unique(self.code >> (BITS * (_LEVELS - at))) for at in range(self.level, _LEVELS + 1)
        }

    def near(self, rows: pd.DataFrame) -> pd.DataFrame:
        """(word, n_near, less_n, form) of words that have near ones among these searches."""
        who = np.arange(len(rows))
        code, prefix = rows["code"].to_numpy(), rows["prefix"].to_numpy()
        more, less = rows["more"].to_numpy(bool), rows["less"].to_numpy(bool)
        for level in range(self.level + 1, _LEVELS + 1):
            own = (code[who] >> (BITS * (_LEVELS - level))) & _MOST
            known, parts = self.levels[level], []
            for step, may in ((0, slice(None)), (1, more), (-1, less & ~more)):
                one, before, up, down = who[may], prefix[may], more[may], less[may]
                child = own[may] + step
                new = (before << BITS) | (child & _MOST)
                place = np.minimum(np.searchsorted(known, new), len(known) - 1)
                ok = (known[place] == new) & (child >= 0) & (child <= _MOST)
                parts.append((one[ok], new[ok], up[ok] & (step != 1), down[ok] & (step != -1)))
            who, prefix, more, less = (np.concatenate(x) for x in zip(*parts))
        low, high = np.searchsorted(self.code, prefix), np.searchsorted(self.code, prefix, "right")
        names = [*self.names, *rows["word"].tolist()]
        n = np.r_[self.n, rows["n"].to_numpy()]
        words = [w.encode("latin-1") for w in names]
        flat = np.frombuffer(b"".join(words), np.uint8)
        size = np.fromiter(map(len, words), np.int64, len(words))
        start = np.r_[0, np.cumsum(size)[:-1]]
        pairs = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        total = np.cumsum(high - low)
        at = 0
        while at < len(who):
            # As many leaves as hold CELLS / 16 candidates, one at least.
            base = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, base + CELLS // 16, "right")))
            width = (high - low)[at:to]
            p = np.repeat(who[at:to], width) + len(self.names)
            q = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(low[at:to], width)
            near = one_edit(flat, start, size, p, q)
            # Words with equal counts find each other; of others only one finds the other.
            once = near & ~np.repeat(more[at:to], width)
            pairs += [(p[near], q[near]), (q[once], p[once])]
            at = to
        one, other = (np.concatenate(x) for x in zip(*pairs))
        rank = np.empty(len(names), np.int64)
        rank[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
        order = np.lexsort((rank[other], -n[other], one))
        one, other = one[order], other[order]
        first = np.flatnonzero(np.r_[True, one[1:] != one[:-1]]) if len(one) else np.empty(0, np.int64)
        return pd.DataFrame({
            "word": np.array([names[i] for i in one[first]], object),
            "n_near": np.diff(np.r_[first, len(one)]).astype(np.int64), "less_n": -n[other[first]],
            "form": np.array([names[i] for i in other[first]], object),
        })


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n) of ``words(word, n)`` with near words; ``form`` is the commonest."""
    importable(words.sparkSession)

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            names = rows["word"].tolist()
            yield pd.DataFrame({
                "word": np.array(names, object), "n": rows["n"],
                "code": trie_code([w.encode("latin-1") for w in names]),
            })

    node = ["level", "prefix", "block", "copy"]

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        home, held, at = None, [], None
        for batch in batches:
            for key, group in batch.groupby(node, sort=False):
                if key != at:
                    home, held, at = None, [], key
                # Words of a home come before its searches, maybe in several batches.
                asks = group["asks"].to_numpy(bool)
                if not asks.all():
                    held.append(group[~asks])
                if asks.any() and held:
                    if home is None:
                        home = _Home(pd.concat(held))
                    near = home.near(group[asks])
                    if len(near):
                        yield near

    coded_words = written(words.select("word", "n").mapInPandas(coded, "word string, n long, code long"))
    homes, waiting = _nodes(coded_words)
    crowded = written(waiting.groupBy(node[:3]).agg(F.count("*").alias("size")).where(F.col("size") > SEARCHES))
    copies = crowded.select(*node[:3], F.ceil(F.col("size") / SEARCHES).cast("int").alias("copies"))
    number = F.coalesce("copies", F.lit(1))
    met = homes.join(copies, node[:3], "left").withColumn(
        "copy", F.explode(F.sequence(F.lit(0), number - 1))
    ).withColumn("asks", F.lit(False)).union(
        waiting.join(copies, node[:3], "left").withColumn(
            "copy", F.pmod(F.xxhash64("word"), number).cast("int")
        ).withColumn("asks", F.lit(True))
    ).drop("copies").repartition(*node).sortWithinPartitions(*node, "asks")
    parts = met.mapInPandas(searched, "word string, n_near long, less_n long, form string")
    return parts.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct("less_n", "form")).alias("x")
    ).select("word", "n_near", F.col("x.form").alias("form"), (-F.col("x.less_n")).alias("form_n"))


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for ``words(word, n)``, words of Latin-1 letters.

    ``form`` is the commonest near word if it occurs at least ``ratio`` (above one) times as often.
    Forms are strictly commoner, so following them ends; chains have a logarithmic length and are
    halved by every join.
    """
    words = written(with_names(words, ["word", "n"]))
    found = written(near_words(words))
    every = written(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        *[F.when(F.col("form_n") >= F.col("n") * ratio, F.col(c)).alias(c) for c in ("form", "form_n")],
    ))
    steps = every.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = written(steps.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        ))
        done = steps.where("moved").isEmpty()
        steps = steps.drop("moved")
        if done:
            break
    return every.join(steps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
