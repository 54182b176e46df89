"""Documents to token ids in five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmosaic.llm.common import fold, materialize, table
from flowmosaic.llm.linededup import drop_repeated_lines
from flowmosaic.llm.mixing import mix, row_key
from flowmosaic.llm.pieces import encode
from flowmosaic.llm.simhash import near_duplicates
from flowmosaic.llm.toxicity import fit_toxicity, score_toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the classifier learns from the labels outside the test fold.

    Null and empty texts have the score of the bias alone, equal texts the same one; repeated ids are judged
    row by row. Columns of the documents keep their values, whatever their names.
    """
    learned = fold(F.col("doc_id"), 5) != 0
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(learned)
    weights = fit_toxicity(docs.select("doc_id", "text").filter(learned), labels)
    names = {c.lower() for c in docs.columns}
    score, predicted = (next(n for n in (f"_{word}{'_' * i}" for i in range(len(names) + 1)) if n not in names) for word in ("score", "predicted"))
    return score_toxicity(docs, weights, score=score, predicted=predicted).filter(F.col(predicted) == 0).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line, or nearly so, are taken out of their documents."""
    return drop_repeated_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays, the one with the smallest id (a null id counts as largest).

    Documents without words are a group like any other: they are equal texts. Rows that repeat an id are
    told apart by their contents; of rows equal in everything one stays.
    """
    row = row_key(docs)
    named = docs.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row.alias("row")).alias("_id"), "text")
    classes = materialize(near_duplicates(named, "_id").select("_id", "component_id"), "classes")
    later = classes.filter("_id <> component_id").select(F.col("_id.row").alias("_row")).distinct()
    first = classes.filter("_id = component_id").select(F.col("_id.row").alias("_row"))
    repeated = first.groupBy("_row").count().filter("count > 1").select("_row")
    left = docs.withColumn("_row", row).join(later, "_row", "left_anti")
    once, many = left.join(repeated, "_row", "left_anti"), left.join(repeated, "_row", "left_semi").dropDuplicates(["_row"])
    return once.unionByName(many).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the numbers that bring every source to its target."""
    return mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their pieces instead of the text."""
    return encode(docs).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]
#: Trained models, balanced sampling and iterated links have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
