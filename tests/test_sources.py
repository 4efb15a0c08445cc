"""Scans and sinks on files written by the test."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from tabulon.functions import fields_of_line, items_of_line, path_part
from tabulon.session import scratch_path, shared_folder
from tabulon.sources import (
    MOVIE_SCHEMA,
    RATING_SCHEMA,
    load_pipeline,
    read_csv,
    read_documents,
    read_libsvm,
    read_lines,
    save_model,
    string_schema,
    write_csv,
    write_libsvm,
)


def test_csv_header_in_every_file(spark, tmp_path):
    for name, rows in (("a", "1,10,4.5,7\n"), ("b", "2,20,3.0,8\n")):
        (tmp_path / f"{name}.csv").write_text("userId,movieId,rating,timestamp\n" + rows)
    found = read_csv(spark, str(tmp_path), RATING_SCHEMA).orderBy("userId")
    assert [tuple(r) for r in found.collect()] == [(1, 10, 4.5, 7), (2, 20, 3.0, 8)]
    inferred = read_csv(spark, str(tmp_path))
    assert dict(inferred.dtypes) == {"userId": "int", "movieId": "int", "rating": "double", "timestamp": "int"}


def test_quoted_titles_keep_commas(spark, tmp_path):
    text = 'movieId,title,genres\n11,"American President, The (1995)",Comedy|Drama\n12,"Say ""hi""",Drama\n'
    (tmp_path / "movies.csv").write_text(text)
    found = read_csv(spark, str(tmp_path), MOVIE_SCHEMA).orderBy("movieId").collect()
    assert [r["title"] for r in found] == ["American President, The (1995)", 'Say "hi"']
    lines = read_lines(spark, str(tmp_path)).where(F.col("value").startswith("11"))
    field = lines.select(fields_of_line("value", MOVIE_SCHEMA)["title"].alias("t")).first()["t"]
    assert field == "American President, The (1995)"


def test_single_csv_file(spark, tmp_path):
    df = spark.range(100).repartition(4).select("id", (F.col("id") * 0.5).alias("loss"))
    write_csv(df, str(tmp_path / "out"), single_file=True)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 1
    assert read_csv(spark, str(tmp_path / "out"), "id LONG, loss DOUBLE").count() == 100


def test_minimum_partitions(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("".join(f"{i}\n" for i in range(100)))
    wide = read_lines(spark, str(tmp_path), min_partitions=6)
    assert wide.rdd.getNumPartitions() >= 6 and wide.count() == 100


def test_documents_by_topic_and_id(spark, tmp_path):
    for topic, name, text in (("comp.graphics", "37261", "one\ntwo\n"), ("alt.atheism", "51060", "three")):
        (tmp_path / topic).mkdir()
        (tmp_path / topic / name).write_text(text)
    found = read_documents(spark, str(tmp_path / "*")).orderBy("id")
    assert [tuple(r) for r in found.collect()] == [
        ("37261", "one\ntwo\n", "comp.graphics"),
        ("51060", "three", "alt.atheism"),
    ]


def test_string_schema():
    schema = string_schema("id text topic")
    assert schema.simpleString() == "struct<id:string,text:string,topic:string>"
    assert all(field.nullable for field in schema.fields)


def test_libsvm_round_trip(spark, tmp_path):
    rows = [(1.0, Vectors.dense([0.0, 2.5])), (0.0, Vectors.sparse(2, [(0, -1.0)]))]
    write_libsvm(spark.createDataFrame(rows, ["label", "features"]), str(tmp_path / "v"))
    found = read_libsvm(spark, str(tmp_path / "v"), num_features=2).orderBy("label")
    assert [(r["label"], r["features"].toArray().tolist()) for r in found.collect()] == [
        (0.0, [-1.0, 0.0]),
        (1.0, [0.0, 2.5]),
    ]


def test_basket_lines(spark):
    df = spark.createDataFrame([("  a b c \n",), ("d",)], "line string")
    assert [r[0] for r in df.select(items_of_line("line")).collect()] == [["a", "b", "c"], ["d"]]


def test_path_parts(spark):
    df = spark.createDataFrame([("file:/x/topic/17",), ("17",)], "p string")
    found = df.select(path_part("p", 1).alias("id"), path_part("p", 2).alias("topic")).collect()
    assert [tuple(r) for r in found] == [("17", "topic"), ("17", None)]


def test_pipeline_save_and_load(spark, tmp_path):
    from tabulon.plans import jobs

    rows = [(0, "good spark text", 1.0), (1, "bad other words", 0.0)]
    tokens = jobs.text_tokens(spark.createDataFrame(rows, "id long, text string, label double"))
    model = jobs.classify_text(tokens, num_features=50)
    save_model(model, str(tmp_path / "m"))
    save_model(model, str(tmp_path / "m"))
    again = load_pipeline(str(tmp_path / "m"))
    before = model.transform(tokens).select("id", "prediction").collect()
    assert sorted(before) == sorted(again.transform(tokens).select("id", "prediction").collect())


class Context:
    """Stands in for a context: the real setting is fixed when a session starts."""

    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, settings):
        self.sparkContext = Context(master)
        self.conf = settings


def test_shared_folder_follows_the_session():
    session = Session("spark://somewhere:7077", {"spark.checkpoint.dir": "hdfs:///shared"})
    assert shared_folder(session) == "hdfs:///shared"
    assert session.sparkContext.folder == "hdfs:///shared"
    first, second = scratch_path(session, "x"), scratch_path(session, "x")
    assert first.startswith("hdfs:///shared/x-") and first != second


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        shared_folder(Session("spark://somewhere:7077", {}))
