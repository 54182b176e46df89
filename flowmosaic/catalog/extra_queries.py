"""Queries: dense tensor files, pairing by position, Poisson bootstrap, feature selection, sparse days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmosaic.catalog.learning_queries import _SPLIT_SCALED, _vector_split
from flowmosaic.catalog.registry import query
from flowmosaic.catalog.sql import descent_sql, fine_uniform_sql, weight_sql, with_ctes
from flowmosaic.catalog.tables import SEED, SPEC, WIDTH, event_flow, table, vectors
from flowmosaic.catalog.tables_queries import CELL, key, r
from flowmosaic.operators import align, models, quality, select, splits
from flowmosaic.session import shared_dir
from flowmosaic.sources import tensors


@query(with_ctes("flow", """SELECT date, slot, grid_row, grid_col,
    round(inflow, 4) AS inflow, round(outflow, 4) AS outflow FROM flow"""))
def tensor_file_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flow cube as dense files; the second write must replace the first."""
    path, flow = shared_dir(spark, "cube"), event_flow(spark, sf_dir)
    tensors.write_tensor_files(flow.withColumn("inflow", F.lit(-1.0)), path, SPEC)
    tensors.write_tensor_files(flow, path, SPEC)
    return tensors.scan_tensor_files(spark, path, SPEC).select(key(), *CELL, r("inflow", 4), r("outflow", 4))


_ZIPPED = """zipped AS (SELECT a.position, vec_id, doc_id, quality
        FROM (SELECT row_number() OVER () - 1 AS position, vec_id FROM embeddings) a
        FULL JOIN (SELECT row_number() OVER () - 1 AS position, doc_id, quality FROM labels) b USING (position))"""


def _zipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = align.with_position(spark, f"{sf_dir}/embeddings.parquet", "vec_id")
    return align.zip_by_position(left, align.with_position(spark, f"{sf_dir}/labels.parquet", "doc_id", "quality"))


@query(f"WITH {_ZIPPED} SELECT vec_id, doc_id, quality, vec_id IS NOT NULL AND doc_id IS NOT NULL AS paired FROM zipped")
def zip_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables row by row; the longer one's rest has no partner."""
    return _zipped(spark, sf_dir).select("vec_id", "doc_id", "quality", "paired")


@query(f"""WITH {_ZIPPED} SELECT count(*) FILTER (WHERE vec_id IS NOT NULL AND doc_id IS NOT NULL) AS n_paired,
    count(*) FILTER (WHERE vec_id IS NULL OR doc_id IS NULL) AS n_unpaired FROM zipped""")
def zip_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.zip_lengths(_zipped(spark, sf_dir))


@query(with_ctes("vec_long", """SELECT vec_id, y AS label,
    CASE WHEN list_inner_product(w, f) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
    FROM split_rows CROSS JOIN best WHERE NOT is_train""",
    _SPLIT_SCALED + ",\n" + descent_sql("train_rows", WIDTH, models.L2_REG, "best")))
def predictions_zipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fitted model's predictions and the labels, written apart and paired by their places."""
    train, test = _vector_split(spark, sf_dir)
    out = models.predict(models.fit_classifier(train, 2, 1000, seed=SEED), test)
    paths = [shared_dir(spark, name) for name in ("predictions", "labels")]
    out.select("vec_id", "prediction").orderBy("vec_id").select("prediction").write.parquet(paths[0])
    test.select("vec_id", "label").coalesce(1).sortWithinPartitions("vec_id").write.parquet(paths[1])
    zipped = align.zip_by_position(
        align.with_position(spark, paths[0], "prediction"), align.with_position(spark, paths[1], "vec_id", "label")
    )
    return zipped.select("vec_id", "label", "prediction")


_REPLICATES = 4


@query(f"""SELECT CAST(replicate AS INTEGER) AS replicate, vec_id, label, CAST(copies AS INTEGER) AS copies FROM (
    SELECT replicate, vec_id, label, {" + ".join(f"(u >= {t!r})::INTEGER" for t in splits.poisson_thresholds(1.0))} AS copies FROM (
        SELECT replicate, vec_id, label, {fine_uniform_sql("poisson", "replicate", "vec_id")} AS u
        FROM embeddings CROSS JOIN (SELECT unnest(range({_REPLICATES})) AS replicate) b) d) c WHERE copies > 0""")
def bootstrap_poisson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four replicates; every row's number of copies is drawn on its own."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.explode(F.sequence(F.lit(0), F.lit(_REPLICATES - 1))).alias("replicate"))
    return splits.bootstrap_poisson(rows, ["vec_id"], F.col("replicate"), 1.0, SEED).select("replicate", "vec_id", "label", "copies")


@query(with_ctes("vec_long", """SELECT CAST(row_number() OVER (ORDER BY round(statistic, 9) DESC, i) AS INTEGER) AS rank, i,
    round(statistic, 5) AS statistic, degrees FROM (
        SELECT i, any_value(n) * (sum(o * o / (CAST(nx AS DOUBLE) * ny)) - 1) AS statistic,
               (count(DISTINCT b) - 1) * (count(DISTINCT label) - 1) AS degrees FROM (
            SELECT *, sum(o) OVER (PARTITION BY i, b) AS nx, sum(o) OVER (PARTITION BY i, label) AS ny, sum(o) OVER (PARTITION BY i) AS n
            FROM (SELECT i, floor(x * 4) AS b, label, count(*) AS o FROM vec_long GROUP BY 1, 2, 3) c) m GROUP BY i) s
    QUALIFY rank <= 10"""))
def chi_square_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten features that depend most on the label, in classes a quarter wide."""
    rows = vectors(spark, sf_dir).withColumn("classes", F.transform("features", lambda x: F.floor(x * 4)))
    return select.chi_square_top(rows, "classes", "label", 10).select("rank", "i", r("statistic", 5), "degrees")


@query(with_ctes("vec_long", """SELECT vec_id, i, round(CASE WHEN norm > 0 THEN x / norm ELSE x END, 6) AS value
    FROM (SELECT *, sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS norm FROM vec_long) n"""))
def normalize_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = vectors(spark, sf_dir).select("vec_id", F.posexplode(select.normalized(F.col("features"))).alias("i", "value"))
    return unit.select("vec_id", "i", r("value"))


@query(with_ctes("tensor", f"""SELECT date, round(sum(CASE WHEN std > 1e-9 THEN (value - mean) / std * {weight_sql("pos", "0")} ELSE 0 END), 5) + 0.0 AS score,
    count(*) FILTER (WHERE value <> 0) AS n_filled
    FROM tensor JOIN (SELECT pos, avg(value) AS mean, stddev_samp(value) AS std FROM tensor GROUP BY pos) s USING (pos) GROUP BY date"""))
def sparse_day_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised linear scores of whole days, computed from the filled cells."""
    flow = event_flow(spark, sf_dir)
    days = quality.complete_days(flow).select("date")
    at = (F.col("grid_row") * SPEC.cols + F.col("grid_col")) * SPEC.channels + 2 * (F.col("slot") - 1)
    sides = F.explode(F.array(*[F.struct((at + c).cast("int").alias("i"), (F.col(n) / 100).alias("x")) for c, n in enumerate(("inflow", "outflow"))]))
    cells = flow.join(days, "date", "left_semi").select("date", sides.alias("e")).select("date", "e.*").filter("x <> 0")
    weights = spark.range(SPEC.cells * SPEC.channels).select(F.col("id").cast("int").alias("i"), (((F.col("id") * 7) % 11 - 5) / 10.0).alias("w"))
    scores = select.sparse_scores(days, cells, "date", select.sparse_stats(cells, days.count()), weights)
    return scores.select(key(), (F.round("score", 5) + 0.0).alias("score"), "n_filled")
