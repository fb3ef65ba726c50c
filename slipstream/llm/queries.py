"""One query per operator over its whole table, and the SQL it must agree with."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slipstream.llm import (
    balls, bpe, decontam, lines, minhash, neighbours, planes, repeats, shards, spelling, token_counts, toxicity, vectors,
)
from slipstream.llm.common import written
from slipstream.operators.staging import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all embeddings with cosine of at least 0.95."""
    return vectors.link(table(spark, folder, "embeddings"), dims=64)


@query
def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without lines that repeat an earlier line, or one an edit away."""
    return lines.deduplicate(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256")
    )


SQL["op2_line_dedup"] = "with " + lines.LINES_SQL.replace("DOCS", "documents") + """
select doc_id, coalesce(len(string_split(d.text, chr(10))), 0) as n_lines,
    case when d.text is null then 0 else len(string_split(d.text, chr(10))) - coalesce(n, 0) end as n_removed,
    case when d.text is not null then sha256(coalesce(_kept.text, '')) end as text_sha256
from documents d left join _kept using (doc_id)"""


@query
def op3_token_planes(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents written as byte planes and read back."""
    out = f"{shared_folder(spark)}/planes-{uuid.uuid4().hex}"
    path = public_tokenizers.path("word_bpe_49k.json")
    planes.write(table(spark, folder, "documents"), out, path, end_id=2)
    return planes.read_digests(spark, out)


@query
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Overlap of every document with the benchmark."""
    return decontam.mark(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


SQL["op4_decontamination"] = "with " + decontam.OVERLAP_SQL.format(docs="documents") + """
select doc_id, coalesce(n, 0) as n_overlap, n is not null as contaminated
from documents left join _over using (doc_id)"""


@query
def op5_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the words of 35-word windows that occur more than once."""
    return repeats.remove(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


@query
def op6_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose 3-word shingles are alike by 85 in 100."""
    return minhash.near_duplicates(table(spark, folder, "documents"), size=3, num=85, den=100, least=38)


def document_edits(docs: DataFrame) -> DataFrame:
    """Four edits of every document: the first line goes, then every text loses 20 characters in
    the middle, gets its language put into its first third, and its source at the end."""
    size = F.length("text")
    edit = lambda start, length, inserted: F.struct(
        start.cast("long").alias("start"), length.cast("long").alias("length"), inserted.alias("inserted")
    )
    return docs.select("doc_id", F.posexplode(F.array(
        edit(F.lit(0), F.instr("text", "\n"), F.lit("")),
        edit(F.floor(size / 2), F.lit(20), F.lit("")),
        edit(F.floor(size / 3), F.lit(0), F.concat(F.lit(" "), "lang", F.lit(" 2nd's"))),
        edit(F.lit(1 << 40), F.lit(0), F.concat(F.lit("\n"), "source")),
    )).alias("seq", "e")).select("doc_id", "seq", "e.*")


@query
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document before and after four edits."""
    docs = table(spark, folder, "documents")
    return token_counts.count(docs, document_edits(docs), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", "predicted"
    )


@query
def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids of every document and of the text decoded from them."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), path)
    return bpe.decode(coded.select("doc_id", "ids"), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op10_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Uniform shuffle of all documents into 8 shards whose row counts are at most one apart."""
    return shards.shuffle(table(spark, folder, "documents").select("doc_id", "text"), 8).select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of all embeddings, their errors and the digest of the codebooks."""
    return balls.codes(table(spark, folder, "embeddings"), dims=64)


@query
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents with their commonest near word and the word it leads to."""
    return spelling.variants(spelling.vocabulary(table(spark, folder, "documents")))


@query
def op13_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest embeddings of every fiftieth one, by cosine."""
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, dims=64, k=5)
