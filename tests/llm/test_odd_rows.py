"""Every operator on nulls, empty and long texts, repeated rows, clashing columns and an empty table."""

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabulon.llm.chunks import remove_chunks, repeated_chunks
from tabulon.llm.lines import drop_boilerplate
from tabulon.llm.mixing import mix_sources
from tabulon.llm.near import near_duplicates
from tabulon.llm.neighbours import nearest
from tabulon.llm.packing import pack_pow2
from tabulon.llm.pii import find_pii
from tabulon.llm.quality import quality
from tabulon.llm.suffixes import remove_repeats
from tabulon.llm.token_files import read_tokens, write_tokens
from tabulon.llm.tokens import tokenizer_path

WORDS = tokenizer_path("word_bpe_49k.json")


def by_id(df):
    return {row["doc_id"]: row for row in df.collect()}


def test_lines(odd, empty):
    rows = drop_boilerplate(odd, max_ratio=0.3, min_pages=3).collect()
    assert len(rows) == odd.count() and "host" in rows[0]
    found = {r["doc_id"]: r for r in rows}
    assert found[1]["text"] is None and found[1]["n_lines"] == 0
    assert found[2]["text"] == "" and found[2]["n_dropped"] == 0
    assert found[7]["text"] == "" and found[7]["n_dropped"] == 2  # three of seven pages of the host
    assert found[9]["text"] == "\n \r\x0b"
    assert drop_boilerplate(empty).collect() == []


def test_suffixes(odd, empty):
    rows = remove_repeats(odd).collect()
    assert len(rows) == odd.count()
    found = {r["doc_id"]: r for r in rows}
    assert (found[1]["n_bytes"], found[1]["n_removed"]) == (0, 0)
    assert found[4]["n_removed"] == 300000 and found[4]["n_spans"] == 1
    assert found[7]["n_removed"] == 0
    assert remove_repeats(empty).collect() == []


def test_near(odd, empty):
    rows = near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    found = {r["doc_id"]: r for r in rows}
    assert found[7]["component_id"] == 6 and not found[7]["kept"] and found[6]["kept"]
    assert found[1]["n_shingles"] == 0 and found[1]["component_id"] == 1 and found[1]["kept"]
    assert found[2]["component_id"] == 2 and found[9]["component_id"] == 9
    assert found[3]["n_shingles"] == 1
    assert found[None]["component_id"] is None and found[None]["kept"]
    assert near_duplicates(empty).collect() == []
    with pytest.raises(ValueError):
        near_duplicates(odd, percent=50)


def test_neighbours(spark):
    rows = [(i, [float(i % 3), 1.0], "x") for i in range(30)]
    rows += [(40, None, "x"), (60, [0.0, 0.0], "x"), (80, [1.0, float("nan")], "x"), (100, [1.0, None], "x")]
    rows += [(120, [1.0], "x"), (None, [1.0, 1.0], "x"), (3, [0.0, 1.0], "x"), (140, [float("inf"), 1.0], "x"), (160, [], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    found = nearest(df, F.col("vec_id") % 20 == 0, k=5).collect()
    assert {r["query_id"] for r in found} == {0, 20}
    # [2, 1] against [2, 1] is 5, with ties to the smaller id
    assert [(r["vec_id"], r["score"]) for r in sorted(found) if r["query_id"] == 20] == [(2, 5.0), (5, 5.0), (8, 5.0), (11, 5.0), (14, 5.0)]
    assert nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    few = spark.createDataFrame(rows[:4], df.schema)
    assert [r["vec_id"] for r in sorted(nearest(few, F.col("vec_id") == 0).collect())] == [1, 2, 3]


def test_mixing(odd, empty):
    rows = mix_sources(odd).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in odd.collect()}  # nothing is lost without a budget
    assert all(r["epoch"] != "x" for r in rows)
    assert mix_sources(empty).collect() == []
    assert [r["epoch"] for r in mix_sources(odd.where("doc_id = 2")).collect()] == [1]


def test_mixing_keeps_sources_without_words(spark):
    rows = [(1, None, "x"), (4, " \n ", "x"), (2, "one two three", "y"), (3, "", "y"), (5, "a b", None), (6, None, None), (7, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for budget in (None, 100.0):
        found = mix_sources(df, budget=budget).collect()
        assert {r["doc_id"] for r in found} == {1, 2, 3, 4, 5, 6, 7}
        assert [r["epoch"] for r in found if r["source"] in ("x", "z")] == [1, 1, 1]
    assert {r["doc_id"] for r in mix_sources(df.where("doc_id in (1, 4, 7)")).collect()} == {1, 4, 7}


def test_chunks(odd, empty):
    runs = by_id(repeated_chunks(odd, least_run=20))
    assert runs[7]["first_doc_ids"] == [6] and 6 not in runs and 1 not in runs
    out = remove_chunks(odd, repeated_chunks(odd, least_run=20))
    assert out.columns == odd.columns and out.count() == odd.count()
    assert repeated_chunks(empty).collect() == []


def test_quality(odd, empty):
    rows = quality(odd).collect()
    assert len(rows) == odd.count()
    found = {r["doc_id"]: r for r in rows}
    assert found[1]["n_words"] == 0 and found[1]["base_failed"] and not found[1]["kept"]
    assert found[4]["n_words"] == 60000 and found[4]["n_repeat_words"] == 60000
    assert found[9]["n_dup_lines"] == 0
    assert quality(odd, keep_columns=True).columns[:4] == ["doc_id", "text", "lang", "source"]
    assert quality(empty).collect() == []


def test_quality_guard(spark):
    """Words unlike the others' are held against a document only if it has enough of them to judge by."""
    plain = " ".join(f"the w{i} of" for i in range(60))
    rows = [(i, plain, "en") for i in range(30)]
    rows += [(100, " ".join(f"{i}#{i * 7}%" for i in range(70)), "en"), (101, " ".join(f"{i}#{i * 7}%" for i in range(120)), "en")]
    found = by_id(quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    assert found[100]["class_distance"] > 0.25 and found[100]["kept"] and not found[100]["base_failed"]
    assert found[101]["class_distance"] > 0.25 and not found[101]["kept"] and not found[101]["base_failed"]
    assert found[1]["kept"]


def test_token_files(odd, empty, spark, tmp_path):
    path = str(tmp_path / "t")
    write_tokens(odd, path, WORDS, keeps_blanks=False, parts=3)
    rows = sorted(read_tokens(spark, path, with_ids=True).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4, 5, 6, 7, 7, 9, 10]
    assert rows[1]["n_tokens"] == 1 and rows[1]["ids"] == [2]
    assert rows[0]["start"] == 0 and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:]))
    write_tokens(empty, path + "0", WORDS, keeps_blanks=False)
    assert read_tokens(spark, path + "0").collect() == []


def test_pii(odd, empty):
    rows = find_pii(odd).collect()
    assert len(rows) == odd.count() and all(r["spans"] == "" for r in rows)
    assert find_pii(empty).collect() == []


def test_packing(odd, empty):
    rows = pack_pow2(odd, WORDS, longest=64).collect()
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    assert all(r["length"] & (r["length"] - 1) == 0 and r["offset"] == 0 for r in rows)
    assert all(zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r["ids"])) == r["ids_crc32"] for r in rows[:50])
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 1
    assert pack_pow2(empty, WORDS).collect() == []
    with pytest.raises(ValueError):
        pack_pow2(odd, WORDS, longest=100)


def test_pipeline_stages(spark, odd, empty):
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "")
            docs.count()
