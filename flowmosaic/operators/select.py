"""Choosing and normalising features: chi-square statistics, unit rows, scores of sparse days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def normalized(features: Column, p: float = 2.0) -> Column:
    """The array divided by its p-norm (``float("inf")``: its largest size); an array of zeros stays as it is."""
    sizes = F.transform(features, F.abs)
    if p == float("inf"):
        norm = F.array_max(sizes)
    else:
        norm = F.pow(F.aggregate(sizes, F.lit(0.0), lambda total, x: total + F.pow(x, F.lit(float(p)))), F.lit(1.0 / p))
    return F.transform(features, lambda x: F.when(norm > 0, x / norm).otherwise(x))


def chi_square(rows: DataFrame, features: str, label: str) -> DataFrame:
    """(i, statistic, degrees, n) of the independence test of each categorical feature and the label.

    ``features`` is an array of category values. Counts per (feature, category, label) come from one
    aggregate with map-side sums; everything after it has one row per such triple. Rows without a label and
    null categories are left out. A feature with one category (or one label) has statistic 0 and no degrees.
    """
    long = rows.filter(F.col(label).isNotNull()).select(F.col(label).alias("_y"), F.posexplode(features).alias("i", "_x"))
    cells = long.filter(F.col("_x").isNotNull()).groupBy("i", "_x", "_y").agg(F.count(F.lit(1)).alias("_o"))
    of = lambda *by: F.sum("_o").over(Window.partitionBy("i", *by))
    parts = cells.withColumn("_n", of()).withColumn("_part", F.col("_o") * F.col("_o") / (of("_x").cast("double") * of("_y")))
    return parts.groupBy("i").agg(
        (F.first("_n") * (F.sum("_part") - 1.0)).alias("statistic"),
        ((F.count_distinct("_x") - 1) * (F.count_distinct("_y") - 1)).alias("degrees"),
        F.first("_n").alias("n"),
    )


def chi_square_top(rows: DataFrame, features: str, label: str, k: int) -> DataFrame:
    """The ``k`` features of the largest statistic, with their rank; ties go to the smaller index."""
    best = chi_square(rows, features, label).orderBy(F.desc(F.round("statistic", 9)), "i").limit(k)
    order = Window.orderBy(F.desc(F.round("statistic", 9)), "i")  # k rows
    return best.withColumn("rank", F.row_number().over(order))


def keep_features(features: Column, kept: list[int]) -> Column:
    """The array reduced to the features ``kept``, in their order."""
    return F.array(*[F.get(features, F.lit(i)) for i in kept])


def sparse_stats(cells: DataFrame, n_rows: int) -> DataFrame:
    """(i, mean, std) from (key, i, x) rows that leave zeros out; features without any row have none (all zero)."""
    parts = cells.groupBy("i").agg(F.avg("x").alias("_m"), F.var_pop("x").alias("_v"), F.count("x").cast("double").alias("_f"))
    n = F.lit(float(n_rows))
    # squares about the mean: those of the filled cells about their own mean, and what the zeros add
    squares = F.col("_f") * F.col("_v") + F.col("_f") * (n - F.col("_f")) / n * F.col("_m") * F.col("_m")
    return parts.select("i", (F.col("_m") * F.col("_f") / n).alias("mean"), F.sqrt(squares / (n - 1)).alias("std"))


def sparse_scores(rows: DataFrame, cells: DataFrame, key: str, stats: DataFrame, weights: DataFrame) -> DataFrame:
    """(key, score, n_filled): a linear score on standardised features, from the filled cells alone.

    ``weights`` is (i, w). Centring would fill every cell; its share of the score is the same for all rows
    and is taken off as one number. Constant features count as zero. Rows without cells have that number.
    """
    folded = stats.filter("std > 0").join(weights, "i").select("i", (F.col("w") / F.col("std")).alias("_w"), (F.col("w") * F.col("mean") / F.col("std")).alias("_c"))
    shift = folded.agg(F.coalesce(F.sum("_c"), F.lit(0.0))).scalar()
    sums = cells.join(folded, "i", "left").groupBy(key).agg(F.sum(F.col("x") * F.coalesce("_w", F.lit(0.0))).alias("_s"), F.count("x").alias("_f"))
    return rows.select(key).join(sums, key, "left").select(
        key, (F.coalesce("_s", F.lit(0.0)) - shift).alias("score"), F.coalesce("_f", F.lit(0)).alias("n_filled")
    )
