"""Packing by power-of-two decomposition: each sequence is one piece of one document.

A document of ``n`` ids is cut into as many full pieces of ``longest`` ids as
fit, then into pieces whose lengths are the powers of two in the binary form of
the rest, longest first. Pieces of equal length form a bucket. Every piece is a
sequence of its own, so no sequence crosses documents and none needs padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import by_batch, offsets_before, stored, sub_batches
from tabulon.llm.tokens import encoder

#: Pieces of text that a worker remembers: it lies beside a JVM that the stages before have filled.
PACK_UNITS = 300_000

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "bucket int, part int, place long"
)


def binary_lengths(n: int, longest: int) -> list[int]:
    """``n`` as full lengths and then falling powers of two; none for 0."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def cut_documents(
    docs: DataFrame, path: str, keeps_blanks: bool, id_col: str, text_col: str, longest: int, with_ids: bool
) -> DataFrame:
    """One row per piece, numbered within its task and bucket."""
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        reached = [0] * longest.bit_length()
        encode = encoder(path, keeps_blanks, PACK_UNITS).encode
        for batch in sub_batches(batches):
            ids, counts = encode(batch.column(1).to_pylist())
            ids = np.ascontiguousarray(ids, "<u4")
            rows: list[tuple] = []
            at = 0
            for doc, n in zip(batch.column(0).to_pylist(), counts.tolist()):
                start = 0
                for length in binary_lengths(n, longest):
                    bucket = length.bit_length() - 1
                    piece = ids[at + start : at + start + length]
                    row = (doc, start, length, zlib.crc32(piece), n, bucket, part, reached[bucket])
                    rows.append((*row, piece.astype(np.int32)) if with_ids else row)
                    reached[bucket] += 1
                    start += length
                at += n
            columns = list(zip(*rows)) or [[] for _ in range(8 + with_ids)]
            names = "doc_id start length ids_crc32 doc_tokens bucket part place".split()
            kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            if with_ids:
                arrays.append(pa.array(columns[8], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).transform(by_batch, cut, schema)


def pack_pow2(
    docs: DataFrame,
    path: str,
    *,
    keeps_blanks: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    longest: int = 4096,
    with_ids: bool = True,
) -> DataFrame:
    """Pack token ids of whole texts into sequences of power-of-two lengths.

    Returns one row per piece: doc_id, start (ids of its document before it),
    length, ids_crc32 (unsigned, over little-endian unsigned 32-bit ids),
    doc_tokens, sequence_id, offset (0: the piece is its sequence), bucket
    (log2 of the length) and, if asked for, the ids. Sequences are numbered from 0
    without gaps, shortest bucket first. Tokens are made once: the pieces are
    written to the shared scratch folder, and only one row per task and bucket is
    summed in one place.

    A null or empty text is a document of the end id alone. Repeated rows are
    packed once each. A null doc_id is kept. Further columns are not looked at.
    An empty table gives an empty result. ``longest`` must be a power of two.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    pieces = stored(cut_documents(docs, path, keeps_blanks, id_col, text_col, longest, with_ids), "pieces")
    counts = pieces.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("n"))
    before = offsets_before(counts, ["bucket", "part"], "n", "before").select("bucket", "part", "before")
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    return pieces.join(before, ["bucket", "part"]).select(
        *kept,
        (F.col("before") + F.col("place")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        "bucket",
        *(["ids"] if with_ids else []),
    )
