"""Bucket numbers of hashed term counts against the hash function written out."""

import re

from pyspark.ml.functions import vector_to_array

from tabulon.operators import features


def murmur3(data: bytes, seed: int = 42) -> int:
    """The 32-bit hash of the x86 variant, as a signed number."""
    mask = 0xFFFFFFFF

    def rotated(x, r):
        return (x << r | x >> (32 - r)) & mask

    def stirred(k):
        return rotated(k * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask

    h = seed
    whole = len(data) // 4 * 4
    for i in range(0, whole, 4):
        h = (rotated(h ^ stirred(int.from_bytes(data[i : i + 4], "little")), 13) * 5 + 0xE6546B64) & mask
    if data[whole:]:
        h ^= stirred(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ h >> shift) * factor & mask
    return h - (1 << 32) if h >> 31 else h


def test_bucket_numbers(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 60")
    words = features.tokenize(documents, "text")
    for buckets in (20, 1 << 18):
        hashed = features.hash_terms(words, "words", "counts", buckets).select("text", vector_to_array("counts").alias("counts") if buckets == 20 else "counts")
        for row in hashed.collect():
            want = {}
            for word in re.sub(r"\s+$", "", row["text"].lower()).split():
                bucket = murmur3(word.encode()) % buckets
                want[bucket] = want.get(bucket, 0) + 1
            if buckets == 20:
                found = {i: v for i, v in enumerate(row["counts"]) if v}
            else:
                found = dict(zip(row["counts"].indices.tolist(), row["counts"].values.tolist()))
            empty = murmur3(b"") % buckets
            for counts in (want, found):  # doubled blanks make empty tokens, which the plain split does not
                counts.pop(empty, None)
            assert found == want
