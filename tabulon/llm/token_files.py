"""Token ids of documents as blocks of the adaptive range coder, in ascending document order.

The files are Parquet tables whose column ``block`` holds one self-contained block
of the coder's format (see ``coder``) per row; beside it lie the numbers that place
it: ``part`` and ``place`` give its position, ``start`` the ids before it in its
part, ``ids`` its own. Any file system that Spark writes to can keep them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm.coder import read_block, write_block
from tabulon.llm.common import by_batch, offsets_before, sub_batches
from tabulon.llm.tokens import encoder

BLOCK_IDS = 1 << 21
FILE_SCHEMA = "part long, place long, start long, docs long, ids long, block binary"
DIGESTS = "doc_id long, part long, start_in_part long, n_tokens long, ids_crc32 long"


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    keeps_blanks: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
    parts: int | None = None,
) -> None:
    """Write the ids of whole texts, each with the end id, in ascending id order.

    The documents are range partitioned by id into ``parts`` (default: the
    session's shuffle partitions) and sorted within each; part numbers ascend with
    the ids. A block is filled with whole documents up to ``BLOCK_IDS`` ids; a
    longer document has a block to itself. A null text is written as the empty one, a null id
    comes first and is read back as null, repeated rows are written each. Further
    columns are not looked at. An empty table gives files without blocks.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode = encoder(tokenizer, keeps_blanks).encode
        names: list[int | None] = []
        sizes: list[int] = []
        kept: list[np.ndarray] = []
        state = {"place": 0, "start": 0}

        def block() -> pa.RecordBatch:
            ids = np.concatenate(kept)
            row = (part, state["place"], state["start"], len(names), len(ids), write_block(names, np.array(sizes), ids))
            state["place"] += 1
            state["start"] += len(ids)
            names.clear(), sizes.clear(), kept.clear()
            kinds = [pa.int64()] * 5 + [pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], k) for x, k in zip(row, kinds)], "part place start docs ids block".split()
            )

        filled = 0
        for batch in sub_batches(batches, 2 << 20):
            ids, counts = encode(batch.column(1).to_pylist())
            at = 0
            for doc, n in zip(batch.column(0).to_pylist(), counts.tolist()):
                if names and filled + n > BLOCK_IDS:
                    yield block()
                    filled = 0
                names.append(doc)
                sizes.append(n)
                kept.append(ids[at : at + n])
                at += n
                filled += n
        if names:
            yield block()

    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id")
    )
    ordered.transform(by_batch, write, FILE_SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Read the files back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    ``with_ids`` adds the ids. Every block is decoded on its own and its checksum
    compared; a damaged block raises. Only one row per part is summed in one place.
    """
    blocks = spark.read.schema(FILE_SCHEMA).parquet(path)
    schema = DIGESTS + (", ids array<int>" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, 1):
            part, start, data = (batch.column(k)[0].as_py() for k in range(3))
            names, counts, ids = read_block(data)
            ids = ids.astype("<u4", copy=False)
            ends = np.cumsum(counts)
            starts = ends - counts
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
            arrays = [
                pa.array(names, pa.int64()),
                pa.array(np.full(len(names), part)),
                pa.array(starts + start),
                pa.array(counts),
                pa.array(crcs, pa.int64()),
            ]
            columns = "doc_id part start_in_part n_tokens ids_crc32".split()
            if with_ids:
                bounds = np.concatenate([starts[:1], ends]).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int32))))
                columns.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, columns)

    found = blocks.select("part", "start", "block").transform(by_batch, read, schema)
    counts = blocks.groupBy("part").agg(F.sum("ids").alias("n"))
    before = offsets_before(counts, ["part"], "n", "before").select("part", "before")
    return found.join(before, "part").select(
        "doc_id",
        (F.col("before") + F.col("start_in_part")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["ids"] if with_ids else []),
    )
