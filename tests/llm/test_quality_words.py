"""The registered quality rules judge every document that passes the base rules by its distances."""

import corpus_pipeline
from tabulon.llm.queries import op7_quality


def test_documents_of_50_to_99_words_are_judged(spark, tmp_path):
    plain = " ".join(f"the w{i} of" for i in range(60))
    rows = [(i, plain, "en", "a", len(plain)) for i in range(30)]
    for doc_id, n in ((100, 50), (101, 70), (102, 99), (103, 49)):
        odd = " ".join(f"{i}#{i * 7}%" for i in range(n))
        rows.append((doc_id, odd, "en", "a", len(odd)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = {r["doc_id"]: r for r in op7_quality(spark, str(tmp_path)).collect()}
    assert all(found[d]["class_distance"] > 0.25 and not found[d]["kept"] for d in (100, 101, 102))
    assert [found[d]["base_failed"] for d in (100, 101, 102, 103)] == [False, False, False, True]
    assert found[1]["kept"]
    kept = dict(corpus_pipeline.STAGES)["quality rules"](spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in kept.collect()} == set(range(30))
