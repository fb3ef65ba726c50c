"""Removal of repeated and nearly repeated lines, by deletion neighbourhoods.

A line is removed if an earlier line, in the order of (doc_id, line number), is equal to it or one
edit (a character inserted, deleted or substituted) away from it; the earlier line need not be
kept itself. Lines are compared without white space at their ends. Equal lines are found whatever
their length; only lines of ``LEAST`` characters or more are compared by one edit, because shorter
ones an edit apart are mostly different words. Blank lines stay.

Two lines are one edit apart exactly if deleting one character from each, or from the longer one,
gives the same text. All these variants of all lines would be as many rows as there are
characters, so the place of the edit is narrowed first:

1. Equal lines are counted together; only the first of each goes on.
2. A line is cut into pieces. Each piece gives a key: the hash of all that is before and after it,
   and the length. Lines one edit apart agree in the key of the piece that holds the edit. The
   longer one also enters with its piece one character longer. Keys with one line go; lines that
   share a key go on with that piece, cut again, until pieces have ``PIECE`` characters at most.
3. All variants of these pieces by one deletion are joined on their hashes: with the place of the
   deletion for lines of equal length, without it for a longer and a shorter line. A group gives
   its earliest line to the others by an aggregation; no pairs are made within it.
4. The edit distance of the pieces found is verified.

All of it is DataFrame operations. Every step counts before it joins, so hot keys are combined
before the shuffle, and the join with the counts is split by the adaptive skew join. A driver loop
cuts pieces as often as the longest line needs, each time over the lines that are left.

Documents are known by id and a hash of the text: rows that are equal in both are one document and
get the same text. Null ids come first. Null texts stay null. Texts are read whole, and lines have
no maximal length: a line of many characters is cut into pieces in more rounds. Other columns pass
through, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipstream.llm.common import packed, text_key, unpacked, written

LEAST = 16
# Characters of a piece whose variants are made; pieces that a longer piece is cut into.
PIECE, CUTS = 16, 16


def _lines(text: str = "text") -> Column:
    return F.split(F.col(text), "\n")


def _line(x: Column) -> Column:
    return F.trim(x, F.lit(" \t\r\x0b\x0c"))


def _size() -> Column:
    """Characters of a piece, as the shorter line has it: both lines must be cut alike."""
    return F.length("piece") - F.col("longer").cast("int")


def _cut(rows: DataFrame, parts: Column) -> DataFrame:
    """Pieces of pieces: rows (first, key, longer, piece), each once per part.

    A piece of n characters (the shorter line's; a longer line has one more) is cut at i * n / parts.
    """
    rows = rows.withColumn("_parts", parts).withColumn("_n", _size())
    rows = rows.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    rows = rows.withColumns({
        "_from": F.floor(F.col("_i") * F.col("_n") / F.col("_parts")).cast("int"),
        "_to": F.floor((F.col("_i") + 1) * F.col("_n") / F.col("_parts")).cast("int")
        + F.col("longer").cast("int"),
    })
    piece = F.col("piece")
    return rows.select(
        "first",
        F.xxhash64(
            "key", "_i", piece.substr(F.lit(1), F.col("_from")),
            piece.substr(F.col("_to") + 1, F.length(piece)),
        ).alias("key"),
        "longer", piece.substr(F.col("_from") + 1, F.col("_to") - F.col("_from")).alias("piece"),
    )


def _shared(rows: DataFrame) -> DataFrame:
    """Rows whose key belongs to two lines or more, one of them not as the longer one."""
    # Pieces are made twice instead of being written; the keys are few, and their size decides
    # whether the rows must be shuffled at all.
    keys = written(rows.groupBy("key").agg(
        F.count("*").alias("_n"), F.min("longer").alias("_some")
    ).where("_n > 1 and not _some").select("key"))
    return written(rows.join(keys, "key", "left_semi"))


def _variants(rows: DataFrame) -> DataFrame:
    """Variants of pieces: rows (first, longer, piece, kind, variant)."""
    piece = F.col("piece")
    without = F.transform(F.sequence(F.lit(1), F.length(piece)), lambda at: F.struct(
        at.alias("at"),
        F.concat(piece.substr(F.lit(1), at - 1), piece.substr(at + 1, F.length(piece))).alias("text"),
    ))
    nothing = F.array().cast("array<struct<at:int,text:string>>")
    some = F.when(F.length(piece) > 0, without).otherwise(nothing)
    whole = F.array(F.struct(F.lit(0).alias("at"), piece.alias("text")))
    # Places count for lines of one length; a longer line meets the shorter one as a whole.
    same = F.transform(some, lambda v: F.struct(F.lit("same").alias("kind"), v["at"].alias("at"), v["text"].alias("text")))
    more = F.transform(
        F.when(F.col("longer"), some).otherwise(whole),
        lambda v: F.struct(F.lit("more").alias("kind"), F.lit(0).alias("at"), v["text"].alias("text")),
    )
    listed = rows.select("first", "longer", "key", "piece", F.explode(
        F.when(F.col("longer"), more).otherwise(F.concat(same, more))
    ).alias("v"))
    return listed.select(
        "first", "longer", "piece", F.col("v.kind").alias("kind"),
        F.xxhash64("key", "v.kind", "v.at", "v.text").alias("variant"),
    ).distinct()


def near_earlier(firsts: DataFrame) -> DataFrame:
    """``first`` of those distinct lines of ``firsts(line, first)`` that are one edit from an earlier one."""
    size = F.length("line")
    entered = firsts.select(
        "first", F.explode(F.array(F.lit(False), F.lit(True))).alias("longer"), F.col("line").alias("piece"), size.alias("_l"),
    ).select("first", F.xxhash64(F.col("_l") - F.col("longer").cast("int")).alias("key"), "longer", "piece")
    rows = _shared(_cut(entered, F.greatest(F.lit(2), F.ceil(_size() / 512).cast("int"))))
    # Pieces become shorter by a factor each time: as many rounds as the longest line needs.
    while (rows.agg(F.max(_size())).first()[0] or 0) > PIECE:
        rows = _shared(_cut(rows, F.when(
            _size() > PIECE, F.least(F.lit(CUTS), F.ceil(_size() / PIECE).cast("int"))
        ).otherwise(F.lit(1))))
    variants = written(_variants(rows))
    entry = F.struct("first", "piece")
    groups = variants.groupBy("variant", "kind").agg(
        F.min(F.when(~F.col("longer"), entry)).alias("plain"), F.min(F.when(F.col("longer"), entry)).alias("long")
    ).where("kind = 'same' or (plain is not null and long is not null)")
    met = variants.join(groups, ["variant", "kind"])
    other = F.when((F.col("kind") == "same") | F.col("longer"), F.col("plain")).otherwise(F.col("long"))
    return met.withColumn("other", other).where(
        (F.col("other.first") < F.col("first")) & (F.levenshtein("piece", "other.piece", 1) >= 0)
    ).select("first").distinct()


def deduplicate(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` without repeated lines; adds ``n_lines`` and ``n_removed`` (replacing such columns).

    Lines of ``least`` characters or more are compared by one edit; with 1 all that are not blank are.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    needed = ("doc_id", "text")
    docs = packed(docs.select(*[F.col(f"`{c}`") for c in columns]), needed).withColumn("_key", text_key())
    lines = docs.select("doc_id", "_key", F.posexplode(_lines()).alias("at", "line")).withColumn("line", _line(F.col("line")))
    firsts = written(
        lines.where(F.length("line") > 0).groupBy("line")
        .agg(F.min(F.struct("doc_id", "_key", "at")).alias("first"))
    )
    near = near_earlier(firsts.where(F.length("line") >= least))
    kept = firsts.select("first").join(near, "first", "left_anti").select("first.*").groupBy(
        "doc_id", "_key"
    ).agg(F.collect_list("at").alias("_kept")).withColumnsRenamed({"doc_id": "_id", "_key": "_k"})
    split = _lines()
    blank = F.filter(
        F.sequence(F.lit(0), F.size(split) - 1), lambda i: F.length(_line(F.get("_split", i))) == 0
    )
    joined = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_k")), "left")
    joined = joined.withColumn("_split", split).withColumn(
        "_all", F.sort_array(F.concat(blank, F.coalesce("_kept", F.array().cast("array<int>"))))
    )
    text = F.array_join(F.transform("_all", lambda i: F.get("_split", i)), "\n")
    return joined.withColumns({
        "text": F.when(F.col("text").isNotNull(), text),
        "_lines": F.coalesce(F.size("_split"), F.lit(0)).cast("long"),
        "_gone": F.coalesce(F.size("_split") - F.size("_all"), F.lit(0)).cast("long"),
    }).select(
        *unpacked(columns, needed), F.col("_lines").alias("n_lines"), F.col("_gone").alias("n_removed")
    )


# DuckDB SQL: the first line of each text, and lines one edit from an earlier one. Half of such
# lines is equal at one end, which finds the pairs to compare.
LINES_SQL = """
_ll as (select doc_id, unnest(ls) as raw, unnest(range(len(ls))) as pos from (
    select doc_id, string_split(text, chr(10)) as ls from DOCS)),
_l as (select doc_id, pos, raw, trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) as line from _ll),
_f as (select line, min({'d': doc_id, 'a': pos}) as first from _l where length(line) > 0 group by 1),
_h as (select line, first, length(line) as n, unnest([length(line) // 2, (length(line) - 1) // 2,
    (length(line) + 1) // 2]) as h from _f
    where length(line) >= LEAST),
_e as (select distinct line, first, n, h, left(line, h) as s, 'l' as e from _h
    union all select distinct line, first, n, h, right(line, h), 'r' from _h),
_near as (select distinct y.line from _e x join _e y using (h, s, e)
    where x.first < y.first and abs(x.n - y.n) <= 1 and levenshtein(x.line, y.line) = 1),
_kept as (select _l.doc_id, string_agg(raw, chr(10) order by pos) as text, count(*) as n from _l
    left join _f on _l.line = _f.line and _f.first = {'d': _l.doc_id, 'a': _l.pos}
    where length(_l.line) = 0 or (_f.line is not null and _l.line not in (select line from _near))
    group by 1)""".replace("LEAST", str(LEAST))
