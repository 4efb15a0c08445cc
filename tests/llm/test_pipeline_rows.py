"""The stages of the pipeline, row by row: what SQL says of each one's input against what it returns."""

import collections

import corpus_pipeline
import duckdb
from tabulon.llm.common import stored
from tabulon.llm.queries import LINES_SQL, MIX_SQL, NEAR_SQL, QUALITY_SQL

COLUMNS = ", ".join(corpus_pipeline.COLUMNS)


def rows_of(df):
    return collections.Counter(tuple(r) for r in df.select(*corpus_pipeline.COLUMNS).collect())


def told(db, sql):
    return collections.Counter(db.execute(sql).fetchall())


def load(db, df):
    """The stage's input as the table that the SQL reads."""
    frame = df.select(*corpus_pipeline.COLUMNS).toPandas()
    db.execute("CREATE OR REPLACE TABLE documents AS SELECT * FROM frame")


def test_stages_against_sql(spark, folder):
    db = duckdb.connect()
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    load(db, docs)
    docs = stored(stages["quality rules"](spark, docs, folder), "t")
    assert rows_of(docs) == told(db, f"SELECT {COLUMNS} FROM documents JOIN ({QUALITY_SQL}) q USING (doc_id) WHERE q.kept")
    assert 0 < docs.count() < 200

    load(db, docs)
    docs = stored(stages["line dedup"](spark, docs, folder), "t")
    assert rows_of(docs) == told(db, f"SELECT doc_id, text, lang, source, length(text) FROM ({LINES_SQL})")

    load(db, docs)
    before = rows_of(docs)
    docs = stored(stages["near dedup"](spark, docs, folder), "t")
    sql = NEAR_SQL.replace(">= 85 *", ">= 80 *")
    assert sql != NEAR_SQL
    group = dict(db.execute(f"SELECT doc_id, component_id FROM ({sql})").fetchall())
    left = collections.Counter(group[r["doc_id"]] for r in docs.select("doc_id").collect())
    assert left == collections.Counter(set(group.values()))  # one of each group
    assert len(left) < len(group) and not rows_of(docs) - before

    load(db, docs)
    docs = stored(stages["mixing"](spark, docs, folder), "t")
    assert rows_of(docs) == told(db, f"SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars FROM documents d JOIN ({MIX_SQL}) m USING (doc_id)")
    assert set(r[0] for r in rows_of(docs)) == {r[0] for r in db.execute("SELECT doc_id FROM documents").fetchall()}


def test_plan_of_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "mixing", "packing"]
