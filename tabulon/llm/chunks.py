"""Substring removal by content-defined chunks, cut by a gear rolling hash.

A chunk ends where the top bits of the gear hash of the last ``GEAR_BYTES`` bytes are
zero, so an insertion moves the chunks after it along with the text. Chunks are
compared by a 128-bit digest; all but the first occurrence (by document id, then
place) are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tabulon.llm.common import by_batch, sub_batches

GEAR_BYTES, CUT_BITS = 32, 5
LEAST, MOST = 8, 1024
NO_ID = -(1 << 63)

_GEAR = np.random.default_rng(6).integers(0, 1 << 32, 256, np.uint32)


def cut_places(data: np.ndarray) -> np.ndarray:
    """Places before which the hash asks for a cut, never inside a UTF-8 character."""
    gear = _GEAR[data]
    step = 1
    while step < GEAR_BYTES:
        longer = gear.copy()
        longer[step:] += gear[:-step] << np.uint32(step)
        gear = longer
        step *= 2
    places = np.flatnonzero(gear >> np.uint32(32 - CUT_BITS) == 0) + 1
    places = places[places < len(data)]
    return places[data[places] & 0xC0 != 0x80]


def chunk_bounds(text: bytes) -> list[int]:
    """Ends of the chunks of one text: at least ``LEAST`` bytes (but the last), at most about ``MOST``."""
    data = np.frombuffer(text, np.uint8)
    ends, last = [], 0
    for place in [*cut_places(data).tolist(), len(data)]:
        while place - last > MOST:
            cut = last + MOST
            while cut < place and data[cut] & 0xC0 == 0x80:
                cut += 1
            ends.append(cut)
            last = cut
        if place - last >= LEAST or place == len(data) > last:
            ends.append(place)
            last = place
    return ends


def text_key(text: bytes) -> int:
    """A signed 64-bit digest that tells texts of one id apart."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def chunks(docs: DataFrame) -> DataFrame:
    """One row per chunk: digest (two longs), id, key of the text, and start and length in one number."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches):
            digests, ids, keys, places = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = (text or "").encode()
                ends = chunk_bounds(data)
                starts = [0, *ends[:-1]] if ends else []
                digests += [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(starts, ends)]
                ids.append(np.full(len(ends), NO_ID if doc is None else doc))
                keys.append(np.full(len(ends), text_key(data)))
                begin = np.array(starts, np.int64)
                places.append(begin << 12 | (np.array(ends, np.int64) - begin))
            both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            columns = [both[:, 0], both[:, 1], *map(np.concatenate, (ids, keys, places))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["d1", "d2", "id", "text", "place"])

    return docs.transform(by_batch, cut, "d1 long, d2 long, id long, text long, place long")


def repeated_chunks(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_run: int = 100
) -> DataFrame:
    """Runs of neighbouring chunks that occur earlier, ``least_run`` bytes or more together.

    Returns one row per run: doc_id, start and length in bytes of the UTF-8 text,
    first_doc_ids, the documents that have the run's chunks first (the same document,
    if it repeats itself), and text_key, a digest of the text. A document is an id with a text: repeated
    rows are one, and different texts of one id, or without an id, are documents of their own, in the order of id
    (null first) and text_key. Null, empty and short texts have no runs.
    Further columns are not looked at. An empty table gives an empty result.
    """
    own = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    found = chunks(own)
    firsts = (
        found.groupBy("d1", "d2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "text", "place")).alias("first"))
        .where("n > 1")
        .select("d1", "d2", "first")
    )
    later = found.join(firsts.hint("merge"), ["d1", "d2"]).where(F.struct("id", "text", "place") != F.col("first"))
    listed = later.groupBy("id", "text").agg(F.sort_array(F.collect_set(F.struct("place", F.col("first.id").alias("first")))).alias("chunks"))

    def join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches):
            rows = []
            for doc, key, pieces in zip(*(c.to_pylist() for c in batch.columns)):
                runs: list[list] = []
                for piece in pieces:
                    start, length = piece["place"] >> 12, piece["place"] & 0xFFF
                    if runs and runs[-1][0] + runs[-1][1] == start:
                        runs[-1][1] += length
                        runs[-1][2].add(piece["first"])
                    else:
                        runs.append([start, length, {piece["first"]}])
                rows += [(doc, start, n, sorted(first), key) for start, n, first in runs if n >= least_run]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
            columns = list(zip(*rows)) or [[]] * 5
            names = ["doc_id", "start", "length", "first_doc_ids", "text_key"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    runs = listed.transform(by_batch, join_up, "doc_id long, start long, length long, first_doc_ids array<long>, text_key long")
    return runs.select(
        F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"),
        "start",
        "length",
        F.transform("first_doc_ids", lambda x: F.nullif(x, F.lit(NO_ID))).alias("first_doc_ids"),
        "text_key",
    )


def _with_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` (all columns as one), ``own_id``, ``own_text`` and ``own_key``: no name of ``docs`` can clash."""
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = named.select("row", F.col("row")[id_col].cast("long").alias("own_id"), F.col("row")[text_col].cast("string").alias("own_text"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [text_key((t or "").encode()) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], [*batch.schema.names, "own_key"])

    return rows.transform(by_batch, digest, StructType([*rows.schema.fields, StructField("own_key", LongType())]))


def remove_chunks(docs: DataFrame, runs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the runs of :func:`repeated_chunks` taken out of their texts.

    Runs belong to rows by id (null included) and text. Null texts and rows without runs stay as they are.
    """
    spans = runs.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"))
    rows = _with_keys(docs, id_col, text_col)
    joined = rows.join(spans.hint("merge"), F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_key") == F.col("text_key")), "left")
    data = F.encode("own_text", "UTF-8")
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["start"] + s["length"]))
    ends = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.octet_length("own_text").cast("long")))
    pieces = F.zip_with(begins, ends, lambda a, b: F.decode(F.substring(data, (a + 1).cast("int"), (b - a).cast("int")), "UTF-8"))
    text = F.when(F.col("spans").isNull(), F.col("row")[text_col]).otherwise(F.array_join(pieces, ""))
    return joined.select(*[(text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
