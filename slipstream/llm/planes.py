"""Token ids as files of compressed byte planes.

The ids of all documents, in ascending order of id, form one sequence. A file row is a *chunk*:
whole documents, about ``CHUNK_IDS`` ids or one longer document. The chunk's ids are cut into
blocks of ``BLOCK_IDS``; within a block the bytes are transposed, so that all lowest bytes come
first, then all second ones and so on, and each of the four planes of a chunk is compressed with
zstandard. The chunk index stands beside the planes: part, chunk number, ids before the chunk in
its part, number of ids, ids and lengths of its documents. A reader that wants a document or a
position reads the index columns and then the planes of one chunk.

Files are Parquet, written and committed by Spark: they can lie in any store, survive lost
executors, and a task that is run twice leaves one result. Parts are ranges of document ids, so
only the number of ids in each part is needed to number the whole sequence.

Null texts count as empty; every document has at least its end id. Documents with a null id come
first. Equal ids are ordered by a hash of the text, then by the text. Other columns are left out.
An empty table gives no chunks.
"""

from __future__ import annotations

import os
import string
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slipstream.llm.bpe import byte_letters, slices
from slipstream.llm.common import importable, text_key, with_names

BLOCK_IDS = 16_384
CHUNK_IDS = 65_536
PLANES = ("plane0", "plane1", "plane2", "plane3")
# Most pieces between spaces whose ids a task remembers; beyond it the memory starts anew.
REMEMBERED = 1_000_000
# Longer pieces are encoded each time, so that the memory stays bounded.
LONGEST = 64
# Characters that are neither letters, numbers nor white space; a run of them is one pre-token.
MARKS = string.punctuation

CHUNKS = (
    "part int, chunk long, before long, n_ids long, doc_ids array<long>, lengths array<long>, "
    + ", ".join(f"{p} binary" for p in PLANES)
)


def pack(ids: np.ndarray) -> list[bytes]:
    """The four compressed byte planes of unsigned 32-bit ids."""
    data = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    coder = zstandard.ZstdCompressor(level=3)
    blocks = [data[i:i + BLOCK_IDS].T for i in range(0, len(data), BLOCK_IDS)]
    return [coder.compress(b"".join(b[p].tobytes() for b in blocks)) for p in range(4)]


def unpack(planes: list[bytes], n_ids: int) -> np.ndarray:
    """Inverse of ``pack``."""
    data = np.empty((n_ids, 4), np.uint8)
    for p, plane in enumerate(planes):
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(plane, max_output_size=n_ids or 1), np.uint8)
        for i in range(0, n_ids, BLOCK_IDS):
            data[i:i + BLOCK_IDS, p] = raw[i:i + BLOCK_IDS]
    return data.reshape(-1).view("<u4")


def _plain(word: str) -> bool:
    """Lower-case letters of the first 256 characters only; no normal form changes these."""
    return word.isalpha() and (word.isascii() or max(word) <= "\xff") and word == word.lower()


class Encoder(dict):
    """The tokenizers library over the pieces between spaces, whose ids do not depend on others.

    White space is never part of a token of the vocabularies this is for (lower-cased words with
    white space dropped; runs of letters apart from marks), so the ids of a text are those of its
    pieces in order. The dictionary holds the ids of the pieces met, as bytes of unsigned 32-bit
    integers; a piece is encoded when it is looked up for the first time.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model, self.letters = self.library.model, {b: c for c, b in byte_letters().items()}

    def __missing__(self, word: str) -> bytes:
        base = word.rstrip(MARKS)
        low = base.lower()
        if not _plain(low):
            code = _bytes(self.library.encode(word, add_special_tokens=False).ids)
        elif low != word:
            # Plain letters of any case with marks behind them: two pre-tokens.
            code = self[low] + self[word[len(base):]] if base != word else self[low]
        else:
            # Letters that the normaliser leaves alone are one pre-token: the model alone decides.
            letters = low if low.isascii() else "".join(map(self.letters.__getitem__, low.encode()))
            code = _bytes([t.id for t in self.model.tokenize(letters)])
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= LONGEST:
            self[word] = code
        return code

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes of unsigned 32-bit integers."""
        return [b"".join(map(self.__getitem__, t.replace("\n", " ").split(" "))) for t in texts]


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def chunks(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """The chunks of ``docs(doc_id, text)``: one row each, ready to be written as Parquet."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, encoder = TaskContext.get().partitionId(), _encoder(path)
        state = {"chunk": 0, "before": 0}
        ids, lengths, coded, size = [], [], [], 0

        def out() -> pd.DataFrame:
            flat = np.frombuffer(b"".join(coded), "<u4")
            row = [part, state["chunk"], state["before"], len(flat), list(ids), list(lengths), *pack(flat)]
            state["chunk"] += 1
            state["before"] += len(flat)
            return pd.DataFrame([row], columns=["part", "chunk", "before", "n_ids", "doc_ids", "lengths", *PLANES])

        for batch in batches:
            names = iter(batch["doc_id"].astype(object).where(batch["doc_id"].notna(), None))
            for texts in slices([t or "" for t in batch["text"]]):
                for code in encoder.encode(texts):
                    name = next(names)
                    ids.append(None if name is None else int(name))
                    coded.append(code + end)
                    lengths.append(len(code) // 4 + 1)
                    size += lengths[-1]
                    if size >= CHUNK_IDS:
                        yield out()
                        ids, lengths, coded, size = [], [], [], 0
        if ids:
            yield out()

    importable(docs.sparkSession)
    ordered = with_names(docs, ["doc_id", "text"]).withColumn("_key", text_key())
    # Ranges also follow the text, so that rows that share an id (or have none) can be split.
    return (
        ordered.repartitionByRange(F.asc("doc_id"), F.asc("_key"))
        .sortWithinPartitions("doc_id", "_key", "text")
        .select(F.col("doc_id").cast("long"), "text")
        .mapInPandas(run, CHUNKS)
    )


def write(docs: DataFrame, folder: str, path: str, end_id: int = 2) -> None:
    """Encode ``docs`` and write the files to ``folder``."""
    chunks(docs, path, end_id).write.option("compression", "none").parquet(folder)


def read(spark, folder: str) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before), ids."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                flat = unpack([getattr(row, p) for p in PLANES], row.n_ids).astype(np.int32)
                ends = np.cumsum(row.lengths)
                yield pd.DataFrame({
                    "part": np.full(len(ends), row.part, np.int32),
                    "doc_id": pd.array(list(row.doc_ids), dtype="Int64"),
                    "start": row.before + ends - row.lengths,
                    "ids": np.split(flat, ends[:-1]),
                })

    importable(spark)
    files = spark.read.schema(CHUNKS).parquet(folder)
    rows = files.mapInPandas(run, "part int, doc_id long, start long, ids array<int>")
    return rows.join(F.broadcast(_parts(files)), "part").select(
        "doc_id", (F.col("start") + F.col("_first")).alias("start"), "ids"
    )


def read_digests(spark, folder: str) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens, and the crc32 of the ids."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                flat = unpack([getattr(row, p) for p in PLANES], row.n_ids)
                ends = np.cumsum(row.lengths)
                yield pd.DataFrame({
                    "part": np.full(len(ends), row.part, np.int32),
                    "doc_id": pd.array(list(row.doc_ids), dtype="Int64"),
                    "start": row.before + ends - row.lengths,
                    "n_tokens": np.asarray(row.lengths, np.int64),
                    "ids_crc32": [zlib.crc32(x.tobytes()) for x in np.split(flat, ends[:-1])],
                })

    importable(spark)
    files = spark.read.schema(CHUNKS).parquet(folder)
    rows = files.mapInPandas(run, "part int, doc_id long, start long, n_tokens long, ids_crc32 long")
    return rows.join(F.broadcast(_parts(files)), "part").select(
        "doc_id", (F.col("start") + F.col("_first")).alias("start"), "n_tokens", "ids_crc32"
    )


def _parts(files: DataFrame) -> DataFrame:
    """Ids before each part. One row per part, as many as the writing job had tasks."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.groupBy("part").agg(F.sum("n_ids").alias("_n")).select(
        "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
