"""Removal of long repeated byte strings by blockwise sorting of suffixes with a cover sample.

Two suffixes count as repeated where they agree on the first ``LENGTH`` bytes. Sorting
every suffix would move many times the text, so the work is cut down in the way of
difference-cover sorting, with a cover that depends on the content:

1. The cover sample. In every window of ``LENGTH`` bytes the place whose ``GRAM`` bytes
   have the least hash is a sample place. Equal windows have it at the same shift,
   the property that a difference cover has by residues, at a tenth of its density.
2. The buckets. A window's suffix belongs to the bucket of its sample place's bytes;
   neighbouring windows with the same sample place form a run. Buckets with one run hold
   no repeat and are left out.
3. The ranks. A sample place is ranked by the bytes of its whole run. Runs of equal rank
   agree in all their windows: long ties between copies end there, without a look
   at the windows.
4. The blocks. Of each rank one run goes on. The suffixes of a bucket's runs of different rank
   are put in order in one task, a block of buckets of bounded size at a time. A bucket of
   more than ``HOT_RUNS`` runs is ordered by all tasks together, from one number per suffix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import by_batch, stored, sub_batches
from tabulon.llm.shingles import mixed, powers

LENGTH, GRAM = 200, 32
SPAN = LENGTH - GRAM + 1  # places for a gram in a window
PLACE_BITS = 22  # a batch of texts is below 2 ** 22 bytes unless one text is longer
BATCH_BYTES = 1 << 20
BLOCK_BYTES = 1 << 20
HOT_RUNS = 1 << 14

_RNG = np.random.default_rng(200)
_BYTE = _RNG.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RNG.integers(0, 1 << 62, dtype=np.uint64)) * 8 + 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_KEPT: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_KEPT.get("up", ())) < n:
        if n > 1 << PLACE_BITS:
            return powers(_BASE, n), powers(_INVERSE, n)
        _KEPT["up"], _KEPT["down"] = powers(_BASE, n), powers(_INVERSE, n)
    return _KEPT["up"][:n], _KEPT["down"][:n]


class Hashes:
    """Hashes of any stretch of the bytes, from running sums modulo 2 ** 64."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * up[:-1], out=self.sums[1:])

    def all_of(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.empty(0, np.uint64)

    def between(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64))


def _least_places(grams: np.ndarray) -> np.ndarray:
    """For each start the place of the least gram of the next ``SPAN``, the first one of equals."""
    bits = max(PLACE_BITS, len(grams).bit_length())
    low = np.uint64((1 << bits) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = SPAN - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    return (least & low).astype(np.int64)


def runs_of(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """All runs of windows: text number, first window, windows, bucket and rank."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    if len(data) < LENGTH:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    ends = np.cumsum(sizes)
    hashes = Hashes(data)
    grams = hashes.all_of(GRAM)
    place = _least_places(grams)
    windows = np.ones(len(place) + 1, np.int8)  # 1 where a window lies within one text
    for end in ends[:-1]:
        windows[max(0, end - LENGTH + 1) : end] = 0
    windows[-1] = 0
    inside = windows[:-1] == 1
    new = inside.copy()
    new[1:] &= (place[1:] != place[:-1]) | ~inside[:-1]
    start = np.flatnonzero(new)
    stops = np.flatnonzero(inside & ~np.concatenate([inside[1:] & ~new[1:], [False]]))
    number = stops - start + 1
    at = place[start]
    rank = hashes.between(start, start + number + LENGTH - 1)
    rank = mixed(rank + (at - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    text = np.searchsorted(ends, start, "right")
    return text, start - (ends - sizes)[text], number, grams[at].view(np.int64), rank.view(np.int64)


def repeated_suffixes(pieces: list[bytes], bucket: np.ndarray) -> list[np.ndarray]:
    """For each piece which of its windows occur twice or more among the pieces of its bucket."""
    sizes = np.array([len(p) for p in pieces])
    begin = np.cumsum(sizes) - sizes
    counts = sizes - LENGTH + 1
    keys = Hashes(np.frombuffer(b"".join(pieces), np.uint8)).all_of(LENGTH)
    first = np.cumsum(counts) - counts
    where = np.arange(counts.sum()) - np.repeat(first - begin, counts)
    keys = keys[where] ^ mixed(np.repeat(bucket, counts).view(np.uint64))
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return np.split(twice, first[1:])


def row_keys(ids: list[int | None], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A key of 88 bits per row, 64 (id) and 24 (mark), from doc_id and text: only rows equal in both share it."""
    keys = [hashlib.blake2b(t, digest_size=11, salt=b"" if d is None else b"%x" % (d % (1 << 64))).digest() for d, t in zip(ids, texts)]
    high = np.frombuffer(b"".join(k[:8] for k in keys), np.int64)
    low = np.array([int.from_bytes(k[8:]) for k in keys], np.int64)
    return high, low


def _packed(docs: DataFrame) -> DataFrame:
    """Texts as compressed bytes with the key of their rows."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(1)
        for batch in sub_batches(batches):
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            ids, marks = row_keys(batch.column(0).to_pylist(), texts)
            data = pa.array([press.compress(t) for t in texts], pa.binary())
            columns = [batch.column(0), pa.array(ids), pa.array(marks), data]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "id", "mark", "packed"])

    return docs.transform(by_batch, pack, "doc_id long, id long, mark long, packed binary")


def _runs(docs: DataFrame) -> DataFrame:
    """bucket, rank, id, and place: the row's mark, the first window and the number of windows in one number."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, BATCH_BYTES):
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            text, start, number, bucket, rank = runs_of(texts)
            ids, marks = row_keys(batch.column(0).to_pylist(), texts)
            place = marks[text] << 40 | start << 8 | number
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (bucket, rank, ids[text], place)], ["bucket", "rank", "id", "place"]
            )

    return docs.transform(by_batch, find, "bucket long, rank long, id long, place long")


def _mark() -> Column:
    return F.shiftrightunsigned("place", 40).alias("mark")


def _cut(texts: DataFrame, runs: DataFrame, numbers: bool) -> DataFrame:
    """The bytes of each run, or one number per suffix of it."""
    wanted = runs.groupBy("id", _mark()).agg(F.collect_list(F.struct("bucket", "rank", "place")).alias("runs"))
    schema = "bucket long, rank long, " + ("place int, key long" if numbers else "data binary")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in sub_batches(batches, 1 << 18):
            bucket, rank, data = [], [], []
            for packed, runs in zip(batch.column(0), batch.column(1)):
                text = unpress.decompress(packed.as_py())
                for run in runs.as_py():
                    start, n = run["place"] >> 8 & 0xFFFFFFFF, run["place"] & 0xFF
                    bucket.append(run["bucket"])
                    rank.append(run["rank"])
                    data.append(text[start : start + n + LENGTH - 1])
            if not numbers:
                columns = [pa.array(bucket, pa.int64()), pa.array(rank, pa.int64()), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "rank", "data"])
                continue
            for b, r, d in zip(bucket, rank, data):
                keys = Hashes(np.frombuffer(d, np.uint8)).all_of(LENGTH).view(np.int64)
                columns = [np.full(len(keys), b), np.full(len(keys), r), np.arange(len(keys), dtype=np.int32), keys]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "rank", "place", "key"])

    return texts.join(wanted.hint("merge"), ["id", "mark"]).select("packed", "runs").transform(by_batch, cut, schema)


def _sorted_blocks(pieces: DataFrame) -> DataFrame:
    """Order the suffixes of whole buckets, a block at a time: bucket, rank, bits (which windows repeat)."""

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, bytes]] = []
        size = 0

        def found() -> pa.RecordBatch:
            bucket, rank, data = zip(*rows)
            hits = repeated_suffixes(list(data), np.array(bucket, np.int64))
            kept = [k for k, hit in enumerate(hits) if hit.any()]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([bucket[k] for k in kept], pa.int64()),
                    pa.array([rank[k] for k in kept], pa.int64()),
                    pa.array([np.packbits(hits[k]).tobytes() for k in kept], pa.binary()),
                ],
                ["bucket", "rank", "bits"],
            )

        for batch in batches:
            for bucket, rank, data in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and size > BLOCK_BYTES and rows[-1][0] != bucket:
                    yield found()
                    rows.clear()
                    size = 0
                rows.append((bucket, rank, data))
                size += len(data)
        if rows:
            yield found()

    return (
        pieces.repartition("bucket").sortWithinPartitions("bucket").transform(by_batch, order, "bucket long, rank long, bits binary")
    )


def _ordered_by_all(suffixes: DataFrame) -> DataFrame:
    """The same for hot buckets: suffixes are counted by their number, combined in each task first."""
    counts = suffixes.groupBy("bucket", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", "key")
    places = suffixes.join(counts, ["bucket", "key"]).groupBy("bucket", "rank").agg(F.collect_list("place").alias("places"))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for places in batch.column(2).to_pylist():
                hit = np.zeros(max(places) + 1, bool)
                hit[places] = True
                out.append(np.packbits(hit).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.binary())], ["bucket", "rank", "bits"])

    return places.transform(by_batch, bits, "bucket long, rank long, bits binary")


def covered(n: int, starts: list[tuple[int, int, bytes | None]]) -> np.ndarray:
    """Which of a text's ``n`` bytes lie in a repeated window; runs as first window, windows, bits (null: all)."""
    change = np.zeros(n + 1, np.int32)
    for start, number, bits in starts:
        if bits is None:
            change[start] += 1
            change[start + number + LENGTH - 1] -= 1
        else:
            hit = start + np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8))[:number])
            np.add.at(change, hit, 1)
            np.add.at(change, hit + LENGTH, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """Remove each byte of a text that a ``LENGTH``-byte string covers which starts anywhere else as well.

    Texts are UTF-8 bytes; strings never cross documents, overlaps count, and strings are judged
    on the input. Returns per row: doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs), kept_sha256 (of the remaining bytes, joined) and, if asked for, kept (those bytes).

    A null text is the empty one, and a text of fewer than ``LENGTH`` bytes has nothing removed.
    Repeated rows repeat each other's strings; rows are told apart by id and text together, so
    those that share an id, or have none, are documents of their own. A null id stays null. Further columns are not looked at. An empty table
    gives an empty result. Suffixes are compared by 64-bit hashes within their bucket.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    runs = _runs(own)
    shared = runs.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    runs = stored(runs.join(shared.hint("merge"), "bucket"), "runs")
    ranks = stored(
        runs.groupBy("bucket", "rank").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "place")).alias("one")),
        "ranks",
    )
    several = stored(ranks.groupBy("bucket").agg(F.count(F.lit(1)).alias("ranks")).where("ranks > 1"), "buckets")
    open_runs = ranks.join(several.hint("merge"), "bucket").select("bucket", "rank", "one.id", "one.place", "ranks")
    texts = _packed(own)
    found = _sorted_blocks(_cut(texts, open_runs.where(F.col("ranks") <= HOT_RUNS), False))
    if several.where(F.col("ranks") > HOT_RUNS).limit(1).count():
        suffixes = stored(_cut(texts, open_runs.where(F.col("ranks") > HOT_RUNS), True), "suffixes")
        found = found.unionByName(_ordered_by_all(suffixes))
    whole = ranks.where("n > 1").select("bucket", "rank", F.lit(None).cast("binary").alias("bits"))
    part = found.join(ranks.where("n = 1").select("bucket", "rank").hint("merge"), ["bucket", "rank"])
    verdicts = stored(whole.unionByName(part.select("bucket", "rank", "bits")), "verdicts")
    removed = (
        runs.join(verdicts.hint("merge"), ["bucket", "rank"])
        .groupBy("id", _mark())
        .agg(F.collect_set(F.struct("place", "bits")).alias("runs"))
    )
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (
        ", kept binary" if with_text else ""
    )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in sub_batches(batches, 1 << 20):
            rows = []
            for doc, packed, runs in zip(*(c.to_pylist() for c in batch.columns)):
                text = unpress.decompress(packed)
                n_removed = n_spans = 0
                kept = text
                if runs:
                    places = [(r["place"] >> 8 & 0xFFFFFFFF, r["place"] & 0xFF, r["bits"]) for r in runs]
                    gone = covered(len(text), places)
                    n_removed = int(gone.sum())
                    n_spans = int(np.count_nonzero(gone & ~np.concatenate([[False], gone[:-1]])))
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                row = (doc, len(text), n_removed, n_spans, hashlib.sha256(kept).hexdigest())
                rows.append((*row, kept) if with_text else row)
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            names = "doc_id n_bytes n_removed n_spans kept_sha256 kept".split()
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    return texts.join(removed.hint("merge"), ["id", "mark"], "left").select("doc_id", "packed", "runs").transform(by_batch, keep, schema)
