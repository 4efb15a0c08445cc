"""From documents to training sequences: five stages, each on all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``, the last the training sequences. ``run`` writes each stage's
result to the shared scratch folder and reads it back for the next one.

Null and empty texts fail the quality rules. Rows are judged one by one: repeated rows and
rows that share an id, or have none, each pass or fail for their own text. Empty tables make empty results,
and columns beyond those of ``documents`` are left out by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm.common import stored
from tabulon.llm.lines import drop_boilerplate
from tabulon.llm.mixing import mix_sources
from tabulon.llm.near import near_duplicates
from tabulon.llm.packing import pack_pow2
from tabulon.llm.quality import quality
from tabulon.llm.tokens import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality(docs, min_words=50, keep_columns=True).where("kept").select(*COLUMNS)


def drop_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are boilerplate on their source."""
    return drop_boilerplate(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: those that share 80 % or more of their shingles.

    Rows are numbered first and told apart by their number, so a row goes for its own text only,
    whatever its id is: of repeated rows one stays, and so do other texts of an id. Null and empty texts stay.
    """
    rows = stored(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "rows")
    gone = near_duplicates(rows, id_col="row", percent=80).where(~F.col("kept")).select(F.col("doc_id").alias("row"))
    return rows.join(stored(gone, "gone"), "row", "left_anti").select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the weight of its source asks for, at least once."""
    return mix_sources(docs).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two lengths, one piece of one document each, with their ids."""
    return pack_pow2(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", drop_site_lines),
    ("near dedup", keep_one_of_near),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL can't run the tokenizer. The tests hold the first four stages against SQL, row by row, each on the input it gets,
#: and the packing against the library's ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
