"""Benchmark decontamination with spaced seeds.

A document overlaps the benchmark where ``WINDOW`` of its words in a row equal as many of an item,
but for ``SUBSTITUTED`` of them at most. A seed is the hash of the words at the places of a fixed
mask, so that words between them may differ. Whatever two of thirteen words are substituted, one
of the two masks fits into the window without touching them (checked by the tests), so every
overlap has a seed in common with its item at the same distance.

Items shorter than the window are quoted only as a whole: such an item of ``SHORTEST`` words or more
has one seed, the hash of all its words, and overlaps where a text has them unchanged. Which short
lengths occur is looked up first, so benchmarks without short items cost nothing more.

1. Benchmark seeds are made at every place, with the words around.
2. A bit table of ``2 ** BITS`` entries tells which seeds can be among them. It has a fixed size, is
   made by one aggregation and reaches the tasks as the value of a scalar subquery, once each. Texts
   are cut into overlapping blocks, so that a row stays small however long its text is. The seeds
   that pass are kept; a false pass costs a row in the next step and changes nothing.
3. These seeds are joined with the benchmark's; join size decides on broadcast or shuffle, and hot
   seeds are split by the adaptive skew join.
4. Around every hit all windows that hold the seed are verified word by word.

Words are lower-cased and separated by ASCII white space; they are compared as 64-bit hashes. Null
and empty texts, and items of fewer than ``SHORTEST`` words, overlap with nothing. Texts are read
whole, whatever their length. Documents are known by id and a hash of the text, so ids may repeat or
be null; equal rows get equal results. Other columns of documents pass through, whatever their
names; those of the benchmark are not used. Empty tables give no rows, or no overlaps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream.llm.common import bit_table, marked, packed, text_key, unpacked, with_names, written

WINDOW, SUBSTITUTED = 13, 2
# Places of the words that a seed looks at.
MASKS = ((0, 1, 2, 3, 5, 7), (0, 1, 3, 7, 8, 9))
# Fewest words of an item that is looked for as a whole.
SHORTEST = 5
BITS = 20
# Places that are worked on as one row, and the words around them that a window can reach.
BLOCK, REACH = 512, WINDOW - 1
_HASHES = "_hashes"


def _hashed(text: str) -> Column:
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), "[\\x20\\x09-\\x0D]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _slot(seed: Column) -> Column:
    return F.shiftrightunsigned(seed, 64 - BITS).cast("int")


def _blocks(rows: DataFrame, names: list[str]) -> DataFrame:
    """(names, first, _hashes): ``BLOCK`` words in a row with those up to a window around, null where none are."""
    starts = F.when(F.size(_HASHES) > 0, F.sequence(F.lit(0), F.size(_HASHES) - 1, F.lit(BLOCK)))
    # Cut inside the row, so that no block carries the whole text along.
    blocks = F.transform(starts, lambda first: F.struct(first.alias("first"), F.transform(
        F.sequence(first - REACH, first + BLOCK + REACH - 1), lambda at: F.get(_HASHES, at)
    ).alias(_HASHES)))
    return rows.select(*names, F.explode(blocks).alias("x")).select(*names, "x.first", f"x.{_HASHES}")


def _seeds(rows: DataFrame, names: list[str], short: list[int], table: DataFrame | None = None) -> DataFrame:
    """Seeds of every place, with the words up to a window around; those that pass the bit table.

    ``short`` lists lengths of whole items; their seeds are numbered after those of the masks.
    """
    looks = [(n, mask, WINDOW - mask[-1] - 1, WINDOW - 1) for n, mask in enumerate(MASKS)]
    looks += [(len(MASKS) + n, tuple(range(n)), 0, n - 1) for n in short]
    places = _blocks(rows, names).select(
        *names, "first", _HASHES, F.explode(F.sequence(F.lit(REACH), F.lit(REACH + BLOCK - 1))).alias("at")
    )

    def seed(number: int, mask: tuple[int, ...]) -> Column:
        words = [F.get(_HASHES, F.col("at") + F.lit(k)) for k in mask]
        # No place fits into fewer words.
        return F.when(words[-1].isNotNull(), F.xxhash64(F.lit(number), *words))

    def passes(made: Column) -> Column:
        return F.lit(True) if table is None else marked(table.scalar(), _slot(made))

    # Plain expressions of one place, so that most places go before anything is made of them.
    some = [made.isNotNull() & passes(made) for made in (seed(n, mask) for n, mask, _, _ in looks)]
    made = F.array(*[F.struct(
        F.lit(n).alias("mask"), seed(n, mask).alias("seed"), F.lit(before).alias("before"),
        F.lit(before + after + 1).alias("size"),
    ) for n, mask, before, after in looks])
    found = places.where(reduce(lambda a, b: a | b, some)).select(
        *names, "first", _HASHES, "at", F.explode(made).alias("x")
    ).where(F.col("x.seed").isNotNull() & passes(F.col("x.seed")))
    return found.select(
        *names, "x.mask", (F.col("first") + F.col("at") - REACH).alias("place"), "x.seed",
        F.slice(_HASHES, F.col("at") - F.col("x.before") + 1, F.col("x.size")).alias("words"),
    )


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, _key, n_overlap) of documents that overlap: words under overlapping windows."""
    items = with_names(benchmark, ["text"]).select(_hashed("text").alias(_HASHES))
    size = F.size(_HASHES)
    # At most a window's worth of lengths.
    short = [
        r[0] for r in items.where(size.between(SHORTEST, WINDOW - 1)).select(size.alias("n")).distinct().collect()
    ]
    theirs = _seeds(items.where(size >= WINDOW), [], [])
    for n in short:
        theirs = theirs.union(_seeds(items.where(size == n), [], [n]).where(F.col("mask") == len(MASKS) + n))
    theirs = theirs.select("mask", "seed", "words").distinct()
    rows = with_names(docs, ["doc_id", "text"]).select(
        "doc_id", text_key().alias("_key"), _hashed("text").alias(_HASHES)
    )
    slots = theirs.select(_slot(F.col("seed")).alias("slot")).distinct()
    ours = _seeds(rows, ["doc_id", "_key"], sorted(short), written(bit_table(slots, BITS)))
    theirs = theirs.withColumnRenamed("words", "item")
    hits = ours.join(theirs, ["mask", "seed"]).withColumn(
        "same", F.zip_with("words", "item", lambda a, b: F.coalesce(a == b, F.lit(False)).cast("int"))
    ).withColumn("size", F.least(F.size("words"), F.lit(WINDOW)))
    # A window lies whole in both texts if its first and last words are there.
    there = lambda at: F.get("words", at).isNotNull() & F.get("item", at).isNotNull()
    alike = F.when(F.col("size") < WINDOW, F.col("size")).otherwise(WINDOW - SUBSTITUTED)
    starts = F.filter(F.sequence(F.lit(0), F.size("words") - F.col("size")), lambda at: (
        there(at) & there(at + F.col("size") - 1)
        & (F.aggregate(F.slice("same", at + 1, F.col("size")), F.lit(0), lambda n, x: n + x) >= alike)
    ))
    # The words begin ``size - WINDOW`` places before the seed, those of short items at it.
    places = hits.select("doc_id", "_key", "size", F.explode(F.transform(
        starts, lambda at: F.col("place") - (F.size("words") - F.col("size")) + at
    )).alias("start")).distinct()
    # Every window adds the words that those before it do not hold.
    held = F.sort_array(F.collect_list(F.struct("start", (F.col("start") + F.col("size")).alias("stop"))))
    new = lambda x, w: F.greatest(w["stop"] - F.greatest(w["start"], x["upto"]), F.lit(0))
    return places.groupBy("doc_id", "_key").agg(held.alias("all")).select("doc_id", "_key", F.aggregate(
        "all", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto")),
        lambda x, w: F.struct((x["n"] + new(x, w)).alias("n"), F.greatest(x["upto"], w["stop"]).alias("upto")),
        lambda x: x["n"],
    ).alias("n_overlap"))


def _joined(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    found = found.withColumnsRenamed({"doc_id": "_found_id", "_key": "_found_key"})
    return docs.withColumn("_key", text_key()).join(
        found, F.col("doc_id").eqNullSafe(F.col("_found_id")) & (F.col("_key") == F.col("_found_key")), how
    )


def mark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_overlap, contaminated) of every document."""
    return _joined(with_names(docs, ["doc_id", "text"]), overlaps(docs, benchmark), "left").select(
        "doc_id", F.coalesce("n_overlap", F.lit(0)).cast("long").alias("n_overlap"),
        F.col("n_overlap").isNotNull().alias("contaminated"),
    )


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without an overlap, with all their columns."""
    needed = ("doc_id", "text")
    return _joined(packed(docs, needed), overlaps(docs, benchmark), "left_anti").select(
        *unpacked(docs.columns, needed)
    )


# DuckDB SQL for ``mark``: thirteen words with two substituted hold four equal words in a row, and so
# do short items.
OVERLAP_SQL = f"""
_d as (select doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'),
    lambda w: w <> '') as ws from {{docs}}),
_b as (select item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'),
    lambda w: w <> '') as ws from benchmark),
_dw as (select doc_id, unnest(ws) as w, unnest(range(1, len(ws) + 1)) as i from _d),
_bw as (select item_id, unnest(ws) as w, unnest(range(1, len(ws) + 1)) as i from _b),
_dg as (select *, w || ' ' || lead(w, 1) over p || ' ' || lead(w, 2) over p || ' ' || lead(w, 3) over p as g
    from _dw window p as (partition by doc_id order by i)),
_bg as (select *, w || ' ' || lead(w, 1) over p || ' ' || lead(w, 2) over p || ' ' || lead(w, 3) over p as g
    from _bw window p as (partition by item_id order by i)),
_diag as (select distinct doc_id, item_id, _dg.i - _bg.i as off from _dg join _bg using (g)),
_eq as (select doc_id, item_id, off, _dw.i, sum(case when _dw.w = _bw.w then 1 else 0 end) over q as n,
    count(*) over q as size
    from _diag join _bw using (item_id) join _dw using (doc_id) where _dw.i = _bw.i + off
    window q as (partition by doc_id, item_id, off order by _dw.i rows {WINDOW - 1} preceding)),
_sh as (select doc_id, off, len(ws) as size from _diag join (select item_id, ws from _b
        where len(ws) between {SHORTEST} and {WINDOW - 1}) using (item_id)
    join _bw using (item_id) join _dw using (doc_id) where _dw.i = _bw.i + off and _dw.w = _bw.w
    group by doc_id, item_id, off, ws having count(*) = len(ws)),
_over as (select doc_id, count(distinct p) as n from (
    select doc_id, unnest(range(i - {WINDOW - 1}, i + 1)) as p from _eq
    where size = {WINDOW} and n >= {WINDOW - SUBSTITUTED}
    union all select doc_id, unnest(range(off + 1, off + size + 1)) from _sh) group by 1)"""
