"""One query per operator, with production parameters, on the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmosaic.llm.collocations import COLLOCATIONS_SQL, collocations
from flowmosaic.llm.common import fold, table
from flowmosaic.llm.embeddup import near_vectors
from flowmosaic.llm.langid import fit_language_model, identify
from flowmosaic.llm.langmodel import fit as fit_model
from flowmosaic.llm.langmodel import score as score_model
from flowmosaic.llm.linededup import line_classes
from flowmosaic.llm.manifest import MANIFEST_SQL, manifest
from flowmosaic.llm.mixing import mix_digest
from flowmosaic.llm.pieces import decode, encode
from flowmosaic.llm.quality import quality_rules
from flowmosaic.llm.sharding import shard_digest
from flowmosaic.llm.simhash import near_duplicates
from flowmosaic.llm.suffixes import repeated_passages
from flowmosaic.llm.toxicity import fit_toxicity, score_toxicity

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
SHARDS = 8


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality_rules(docs).drop("lang", "text")


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_digest(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARDS)


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    learned = fold(F.col("doc_id"), 5) != 0
    weights = fit_toxicity(docs.filter(learned), labels.filter(learned))
    scored = score_toxicity(docs, weights)
    return scored.select("doc_id", (~learned).alias("held_out"), "score", "predicted")


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = fold(F.col("doc_id"), 3) != 1
    model = fit_language_model(docs.filter(learned))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (~learned).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_digest(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


@query
def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 7) == 2
    model, rare = fit_model(docs.filter(~held_out))
    scored = score_model(docs, model, rare)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
    )


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = decode(encode(docs))
    return back.select("doc_id", "n_pieces", "ids", F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


ORACLES["op11_merkle_manifest"] = MANIFEST_SQL


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


ORACLES["op13_collocations"] = COLLOCATIONS_SQL


@query
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))
