"""Queries: scaling, components, layers, grids, classifiers, saved models and metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmosaic.catalog.registry import query
from flowmosaic.catalog.sql import (
    components_sql,
    descent_sql,
    uniform_sql,
    weight_sql,
    with_ctes,
)
from flowmosaic.catalog.tables import (
    SEED,
    SPEC,
    WIDTH,
    event_days,
    event_flow,
    kernel,
    net_weights,
    predictions,
    vector_points,
    vectors,
    weight,
    weight_column,
)
from flowmosaic.catalog.tables_queries import CELL, key, r
from flowmosaic.functions import scoring
from flowmosaic.functions.arrays import net_tensor, pool_tensor
from flowmosaic.operators import features, grid, metrics, models
from flowmosaic.operators.forward import extract_features as extract_features_op
from flowmosaic.operators.augment import augment_days
from flowmosaic.operators.splits import protocol_aug_raw, protocol_split_augment, split_fraction
from flowmosaic.plans import classify
from flowmosaic.session import shared_dir
from flowmosaic.sources.registry import ModelRegistry

_HARD_AUC = """CASE WHEN tp + fn = 0 THEN 0.0 WHEN tn + fp = 0 THEN 1.0
    ELSE (tp / CAST(tp + fn AS DOUBLE) + tn / CAST(tn + fp AS DOUBLE)) / 2 END"""
_ACCURACY = "(tp + tn) / CAST(tp + fp + tn + fn AS DOUBLE)"

# -- scaling and components ----------------------------------------------------------------------


@query(with_ctes("stats", "SELECT i, round(mean, 6) AS mean, round(std, 6) AS std FROM stats"))
def scaler_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = vector_points(spark, sf_dir)
    return features.scaler_table(points, features.fit_scaler(points)).select("i", r("mean"), r("std"))


@query(with_ctes("stats", """SELECT vec_id, i, round((x - mean) / std, 5) AS value
    FROM vec_long JOIN stats USING (i)"""))
def scaler_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = vector_points(spark, sf_dir)
    scaled = features.fit_scaler(points).transform(points)
    return features.vector_rows(scaled, "vec_id", "scaled").select("vec_id", "i", r("value", 5))


_SPLIT_U = uniform_sql("split", "vec_id")


def _vector_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return classify.split_roles(split_fraction(vector_points(spark, sf_dir), ["vec_id"], 0.8, SEED))


@query(with_ctes("vec_long", """SELECT vec_id, i, round((x - mean) / std, 5) AS value
    FROM (SELECT * FROM drawn WHERE u >= 0.8) t JOIN
    (SELECT i, avg(x) AS mean, stddev_samp(x) AS std FROM drawn WHERE u < 0.8 GROUP BY i) s USING (i)""",
    f"drawn AS (SELECT *, {_SPLIT_U} AS u FROM vec_long)"))
def scaler_cross_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the train part, applied to the test part."""
    train, test = _vector_split(spark, sf_dir)
    scaled = features.fit_scaler(train).transform(test)
    return features.vector_rows(scaled, "vec_id", "scaled").select("vec_id", "i", r("value", 5))


@query(with_ctes("vec_long", """SELECT a.i AS i, b.i AS j, round(covar_samp(a.x, b.x), 6) AS cov
    FROM vec_long a JOIN vec_long b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.i, b.i"""))
def covariance_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.covariance_matrix(vector_points(spark, sf_dir)).select("i", "j", r("cov"))


def _scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = vector_points(spark, sf_dir)
    return features.fit_scaler(points).transform(points)


_COMPONENTS = 3

# Scaled vectors in long form and their covariance, fitted on all rows.
_ALL_SCALED = """z AS MATERIALIZED (SELECT vec_id, i, (x - mean) / std AS z FROM vec_long JOIN stats USING (i)),
cov AS MATERIALIZED (SELECT a.i AS i, b.i AS j, covar_samp(a.z, b.z) AS v
        FROM z a JOIN z b ON a.vec_id = b.vec_id GROUP BY a.i, b.i)"""
_ALL_COMPONENTS = _ALL_SCALED + ",\n" + components_sql("cov", _COMPONENTS, "pc")


def _signed(component: Column) -> Column:
    """A component is only defined up to its sign: make its entry of largest size positive."""
    largest = F.array_max(F.transform(component, F.abs))
    flip = F.array_max(component) < largest
    return F.transform(component, lambda v: F.when(flip, -v).otherwise(v))


def _component_table(spark: SparkSession, model: PCAModel) -> DataFrame:
    """(component, loadings): as many rows as components."""
    rows = [(c, [float(v) for v in model.pc.toArray()[:, c]]) for c in range(model.getK())]
    table = spark.createDataFrame(rows, "component INT, loadings ARRAY<DOUBLE>")
    return table.select("component", _signed(F.col("loadings")).alias("loadings"))


@query(with_ctes("stats", """SELECT DISTINCT CAST(c AS INTEGER) AS component,
    round(eigenvalue / (SELECT sum(v) FROM cov WHERE i = j), 6) AS variance_share FROM pc""", _ALL_COMPONENTS))
def pca_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of variance of each component."""
    model = features.fit_pca(_scaled(spark, sf_dir), _COMPONENTS)
    rows = [(c, float(share)) for c, share in enumerate(model.explainedVariance)]
    shares = spark.createDataFrame(rows, "component INT, variance_share DOUBLE")
    return shares.select("component", r("variance_share"))


@query(with_ctes("stats", """SELECT CAST(c AS INTEGER) AS component, CAST(i AS INTEGER) AS i, round(v, 5) + 0.0 AS loading
    FROM pc""", _ALL_COMPONENTS))
def pca_loadings(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = features.fit_pca(_scaled(spark, sf_dir), _COMPONENTS)
    long = _component_table(spark, model).select(
        "component", F.posexplode("loadings").alias("i", "loading")
    )
    return long.select("component", "i", (F.round("loading", 5) + 0.0).alias("loading"))


@query(with_ctes("stats", """SELECT vec_id, CAST(c AS INTEGER) AS component, round(sum(z * v), 4) + 0.0 AS value
    FROM z JOIN pc USING (i) GROUP BY vec_id, c""", _ALL_COMPONENTS))
def pca_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's projection; components are signed as in ``pca_loadings``."""
    scaled = _scaled(spark, sf_dir)
    model = features.fit_pca(scaled, _COMPONENTS)
    loadings = model.pc.toArray()
    signs = [-1.0 if -column.min() > column.max() else 1.0 for column in loadings.T]
    long = features.vector_rows(model.transform(scaled), "vec_id", "components")
    sign = F.element_at(F.array(*[F.lit(s) for s in signs]), F.col("i") + 1)
    return long.select(
        "vec_id", F.col("i").alias("component"), (F.round(F.col("value") * sign, 4) + 0.0).alias("value")
    )


@query(with_ctes("vec_long", """SELECT vec_id, round(sum(x * x), 5) AS energy
    FROM vec_long GROUP BY vec_id"""))
def pca_full_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All components kept: a rotation, so each row's squared length must survive unchanged."""
    points = vector_points(spark, sf_dir)
    rotated = features.fit_pca(points, WIDTH, "features").transform(points)
    squares = F.aggregate(vector_to_array("components"), F.lit(0.0), lambda acc, x: acc + x * x)
    return rotated.select("vec_id", F.round(squares, 5).alias("energy"))


# Vectors split 80/20 and scaled by the train part, as lists and in long form.
_SPLIT_SCALED = f"""drawn AS (SELECT *, {_SPLIT_U} AS u FROM vec_long),
train_stats AS (SELECT i, avg(x) AS mean, stddev_samp(x) AS std FROM drawn WHERE u < 0.8 GROUP BY i),
split_long AS MATERIALIZED (SELECT vec_id, label, u < 0.8 AS is_train, i, (x - mean) / std AS z
        FROM drawn JOIN train_stats USING (i)),
split_rows AS MATERIALIZED (SELECT vec_id, CAST(label AS DOUBLE) AS y, is_train, list(z ORDER BY i) AS f
        FROM split_long GROUP BY vec_id, label, is_train),
train_rows AS MATERIALIZED (SELECT vec_id, y, f FROM split_rows WHERE is_train)"""

_REDUCED = f"""{_SPLIT_SCALED},
train_cov AS MATERIALIZED (SELECT a.i AS i, b.i AS j, covar_samp(a.z, b.z) AS v
        FROM split_long a JOIN split_long b ON a.vec_id = b.vec_id WHERE a.is_train GROUP BY a.i, b.i),
{components_sql("train_cov", _COMPONENTS, "tc")},
short_long AS MATERIALIZED (SELECT vec_id, label, is_train, c, sum(z * v) AS p
        FROM split_long JOIN tc USING (i) GROUP BY vec_id, label, is_train, c),
short_rows AS MATERIALIZED (SELECT vec_id, CAST(label AS DOUBLE) AS y, is_train, list(p ORDER BY c) AS f
        FROM short_long GROUP BY vec_id, label, is_train),
short_train AS MATERIALIZED (SELECT vec_id, y, f FROM short_rows WHERE is_train),
{descent_sql("train_rows", WIDTH, 0.0, "plain")},
{descent_sql("short_train", _COMPONENTS, 0.0, "short")},
judged AS (SELECT 0 AS pca_k, y, list_inner_product(w, f) > 0 AS hit FROM split_rows CROSS JOIN plain WHERE NOT is_train
        UNION ALL SELECT {_COMPONENTS}, y, list_inner_product(w, f) > 0 FROM short_rows CROSS JOIN short WHERE NOT is_train),
rates AS (SELECT pca_k, count(*) AS n_test, avg(CAST(hit = (y = 1) AS DOUBLE)) AS right_share,
        (avg(CAST(hit AS DOUBLE)) FILTER (WHERE y = 1) + avg(CAST(NOT hit AS DOUBLE)) FILTER (WHERE y = 0)) / 2 AS auc
        FROM judged GROUP BY pca_k)"""


@query(with_ctes("vec_long", """SELECT pca_k, 'logistic_lbfgs' AS model, round(auc, 6) AS auc,
    round(right_share, 6) AS recall, round(right_share, 6) AS precision, round(right_share, 6) AS f1,
    (SELECT count(*) FROM train_rows) AS n_train, n_test FROM rates""", _REDUCED))
def optional_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same classifier with and without components."""
    train, test = _vector_split(spark, sf_dir)
    plain = models.train_model(train, test, 3, 1000).withColumn("pca_k", F.lit(0))
    reduced = models.train_model(train, test, 3, 1000, pca_k=_COMPONENTS)
    both = plain.unionByName(reduced.withColumn("pca_k", F.lit(_COMPONENTS)))
    return both.select(
        "pca_k", "model", r("auc"), r("recall"), r("precision"), r("f1"), "n_train", "n_test"
    )


# -- layers --------------------------------------------------------------------------------------


@query(with_ctes("vec_long", f"""SELECT vec_id, round(sum(x * {weight_sql('i', '0')}) + 0.1, 6) AS score,
    CASE WHEN sum(x * {weight_sql('i', '0')}) + 0.1 > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
    FROM vec_long GROUP BY vec_id"""))
def linear_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = features.linear_score(F.col("features"), weight_column(0), 0.1)
    return vectors(spark, sf_dir).select("vec_id", score.alias("score")).select(
        "vec_id", r("score"), scoring.threshold(F.col("score")).alias("prediction")
    )


@query(with_ctes("vec_long", f"""SELECT vec_id, CAST(j AS INTEGER) AS j,
    round(sum(x * {weight_sql('i', 'j')}) + j / CAST(10 AS DOUBLE), 6) AS value
    FROM vec_long CROSS JOIN (SELECT unnest(range(8)) AS j) u GROUP BY vec_id, j"""))
def dense_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = [[weight(i, j) for j in range(8)] for i in range(WIDTH)]
    layer = features.dense_layer(F.col("features"), weights, [j / 10 for j in range(8)])
    long = vectors(spark, sf_dir).select("vec_id", F.posexplode(layer).alias("j", "value"))
    return long.select("vec_id", "j", r("value"))


@query(with_ctes("flow", """SELECT date, slot, r AS grid_row, c AS grid_col, round(sum(v * w), 5) + 0.0 AS value
    FROM (SELECT date, slot, grid_row - a + 2 AS r, grid_col - b + 2 AS c, inflow AS v,
          ((a * 5 + b) % 7 - 3) / CAST(10 AS DOUBLE) AS w
          FROM flow CROSS JOIN (SELECT CAST(unnest(range(5)) AS INTEGER) AS a) x
          CROSS JOIN (SELECT CAST(unnest(range(5)) AS INTEGER) AS b) y) t
    WHERE r BETWEEN 0 AND 3 AND c BETWEEN 0 AND 3 GROUP BY date, slot, r, c"""))
def grid_stencil(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = grid.grid_stencil(event_flow(spark, sf_dir), SPEC, kernel(), "inflow", "value", unique=True)
    return out.select(key(), *CELL, (F.round("value", 5) + 0.0).alias("value"))


def _pool_sql(size: int) -> str:
    return with_ctes("flow", f"""SELECT date, slot, CAST(grid_row // {size} AS INTEGER) AS grid_row,
    CAST(grid_col // {size} AS INTEGER) AS grid_col, round(max(inflow), 4) AS inflow,
    round(max(outflow), 4) AS outflow FROM flow GROUP BY date, slot, grid_row // {size}, grid_col // {size}""")


def _pooled(spark: SparkSession, sf_dir: str, size: int) -> DataFrame:
    pooled = grid.grid_pool(event_flow(spark, sf_dir), SPEC, size, ["inflow", "outflow"], unique=True)
    return pooled.select(key(), *CELL, r("inflow", 4), r("outflow", 4))


@query(_pool_sql(2))
def grid_pool_2x2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pooled(spark, sf_dir, 2)


@query(_pool_sql(4))
def grid_pool_4x4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pooled(spark, sf_dir, 4)


@query(with_ctes("flow", """SELECT date, slot, CAST(r.v // 2 AS INTEGER) AS grid_row, CAST(c.v // 2 AS INTEGER) AS grid_col,
    round(max(coalesce(inflow, 0) - coalesce(outflow, 0)), 4) + 0.0 AS net
    FROM (SELECT DISTINCT date, slot FROM flow) s CROSS JOIN (SELECT unnest(range(4)) AS v) r
    CROSS JOIN (SELECT unnest(range(4)) AS v) c
    LEFT JOIN flow f ON f.date = s.date AND f.slot = s.slot AND f.grid_row = r.v AND f.grid_col = c.v
    GROUP BY s.date, s.slot, r.v // 2, c.v // 2""").replace("SELECT date, slot, CAST(r.v", "SELECT s.date, s.slot, CAST(r.v"))
def pool_net_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net flow can be negative, so absent cells must be zeros before the maximum."""
    filled = grid.net_flow(grid.zero_fill(event_flow(spark, sf_dir), SPEC, unique=True))
    pooled = grid.grid_pool(filled, SPEC, 2, ["net"], unique=True)
    return pooled.select(key(), *CELL, (F.round("net", 4) + 0.0).alias("net"))


@query(with_ctes("tensor", """SELECT date, CAST(((grid_row // 2) * 2 + grid_col // 2) * 96 + 2 * (slot - 1) + chan AS INTEGER) AS pos,
    round(max(value), 6) AS value FROM tensor GROUP BY date, grid_row // 2, grid_col // 2, slot, chan"""))
def pool_day_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    pooled = pool_tensor(F.col("flow"), SPEC, 2)
    days = grid.day_tensor(grid.scale_flow(event_flow(spark, sf_dir)), SPEC, unique=True)
    long = days.select("date", F.posexplode(pooled).alias("pos", "value"))
    return long.select(key(), "pos", r("value"))


@query(with_ctes("tensor", """SELECT date, CAST(pos // 2 AS INTEGER) AS pos,
    round(sum(CASE WHEN chan = 0 THEN value ELSE -value END), 6) + 0.0 AS value FROM tensor GROUP BY date, pos // 2"""))
def net_day_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid features of the net-flow ablation."""
    days = grid.day_tensor(grid.scale_flow(event_flow(spark, sf_dir)), SPEC, unique=True)
    long = days.select("date", F.posexplode(net_tensor(F.col("flow"))).alias("pos", "value"))
    return long.select(key(), "pos", (F.round("value", 6) + 0.0).alias("value"))


@query()
def ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In- and outflow against net flow alone, same split, same classifier."""
    examples = protocol_split_augment(event_days(spark, sf_dir), 0.8, SEED)
    both = classify.classify_examples(examples, 2, 1000)
    net = classify.classify_examples(examples, 2, 1000, points=classify.net_points)
    return both.withColumn("channels", F.lit("in+out")).unionByName(
        net.withColumn("channels", F.lit("net"))
    )


# -- classifiers ---------------------------------------------------------------------------------


@query(with_ctes("vec_long", """SELECT vec_id, round(list_inner_product(w, f), 4) + 0.0 AS score,
    CASE WHEN list_inner_product(w, f) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
    FROM split_rows CROSS JOIN linear WHERE NOT is_train""",
    _SPLIT_SCALED + ",\n" + descent_sql("train_rows", WIDTH, 0.0, "linear", rate=0.7, logistic=False)))
def linreg_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least squares through the origin on all scaled features, cut at 0; fitted on the train part."""
    out = _fit_predict(spark, sf_dir, 1, 1000)
    return out.select("vec_id", (F.round("score", 4) + 0.0).alias("score"), "prediction")


def _fit_predict(spark: SparkSession, sf_dir: str, kind: int, iterations: int) -> DataFrame:
    train, test = _vector_split(spark, sf_dir)
    model = models.fit_classifier(train, kind, iterations, seed=SEED)
    return models.predict(model, test).select("vec_id", "label", "score", "prediction")


def _logistic_sql(l2: float) -> str:
    return with_ctes("vec_long", """SELECT vec_id, y AS label, round(list_inner_product(w, f), 3) + 0.0 AS score,
    CASE WHEN list_inner_product(w, f) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
    FROM split_rows CROSS JOIN best WHERE NOT is_train""",
    _SPLIT_SCALED + ",\n" + descent_sql("train_rows", WIDTH, l2, "best"))


def _logistic(spark: SparkSession, sf_dir: str, kind: int) -> DataFrame:
    out = _fit_predict(spark, sf_dir, kind, 1000)
    return out.withColumn("score", F.round("score", 3) + 0.0)


@query(_logistic_sql(models.L2_REG))
def logreg_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _logistic(spark, sf_dir, 2)


@query(_logistic_sql(0.0))
def logreg_lbfgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _logistic(spark, sf_dir, 3)


@query()
def linear_svc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_predict(spark, sf_dir, 4, 1000)


@query()
def random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fit_predict(spark, sf_dir, 5, 20)


_CONVEX = f"""{_SPLIT_SCALED},
{descent_sql("train_rows", WIDTH, 0.0, "linear", rate=0.7, logistic=False)},
{descent_sql("train_rows", WIDTH, models.L2_REG, "ridge")},
{descent_sql("train_rows", WIDTH, 0.0, "plain")},
judged AS (SELECT model, y = 1 AS truth, list_inner_product(w, f) > 0 AS hit FROM split_rows CROSS JOIN (
        SELECT 'linear' AS model, w FROM linear UNION ALL SELECT 'logistic_l2', w FROM ridge
        UNION ALL SELECT 'logistic_lbfgs', w FROM plain) fits WHERE NOT is_train),
counts AS (SELECT model, count(*) FILTER (WHERE hit AND truth) AS tp, count(*) FILTER (WHERE hit AND NOT truth) AS fp,
        count(*) FILTER (WHERE NOT hit AND NOT truth) AS tn, count(*) FILTER (WHERE NOT hit AND truth) AS fn
        FROM judged GROUP BY model)"""


@query(with_ctes("vec_long", f"""SELECT model, round({_HARD_AUC}, 6) AS auc, round({_ACCURACY}, 6) AS recall,
    round({_ACCURACY}, 6) AS precision, round({_ACCURACY}, 6) AS f1, (SELECT count(*) FROM train_rows) AS n_train,
    tp + fp + tn + fn AS n_test FROM counts""", _CONVEX))
def bakeoff_convex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three kinds whose optimum is unique and smooth."""
    train, test = _vector_split(spark, sf_dir)
    report = models.model_bakeoff(train, test, [(1, 1000), (2, 1000), (3, 1000)])
    return report.select("model", r("auc"), r("recall"), r("precision"), r("f1"), "n_train", "n_test")


@query()
def model_bakeoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _vector_split(spark, sf_dir)
    runs = [(kind, 20 if kind == 5 else 100) for kind in models.KINDS]
    return models.model_bakeoff(train, test, runs)


@query()
def mlp_day_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default protocol: trained on augmented train days, tested on other raw days."""
    examples = protocol_split_augment(event_days(spark, sf_dir), 0.8, SEED)
    _, out = classify.neural_day_classifier(examples, SPEC, 2, 30, seed=SEED)
    return out.select(key("source_date"), "label", "score", "prediction")


@query()
def mlp_aug_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaking protocol, as a control: every test day has augmented copies among the train days."""
    days = event_days(spark, sf_dir)
    examples = protocol_aug_raw(days, augment_days(days, SEED))
    _, out = classify.neural_day_classifier(examples, SPEC, 2, 30, seed=SEED)
    return out.select(key("source_date"), "label", "score", "prediction")


@query()
def training_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _vector_split(spark, sf_dir)
    return models.accuracy_trace(train, test, 2, [1, 5, 20], SEED)


@query()
def objective_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = _vector_split(spark, sf_dir)
    return models.objective_trace(models.fit_classifier(train, 2, 50), train)


def _layer_sql(i: str, j: str, fan_in: int) -> str:
    return f"((({i}) * 7 + {j} * 13) % 11 - 5) / sqrt({fan_in})"


def _conv_sql(source: str, side: int, channels: int, filters: int) -> str:
    """5x5 convolution with zero padding, bias 0.1, ReLU, then 2x2 pooling, on (date, r, c, ch, v)."""
    return f"""SELECT date, r // 2 AS r, c // 2 AS c, f AS ch, max(greatest(v + 0.1, 0)) AS v FROM (
        SELECT x.date, o.r, o.c, f.f, sum(x.v * w) AS v FROM {source} x
        JOIN (SELECT r, c, a, b FROM (SELECT unnest(range({side})) AS r) CROSS JOIN (SELECT unnest(range({side})) AS c)
              CROSS JOIN (SELECT unnest(range(5)) AS a) CROSS JOIN (SELECT unnest(range(5)) AS b)) o
          ON x.r = o.r + o.a - 2 AND x.c = o.c + o.b - 2
        CROSS JOIN (SELECT unnest(range({filters})) AS f) f
        CROSS JOIN LATERAL (SELECT {_layer_sql(f"(o.a * 5 + o.b) * {channels} + x.ch", "f.f", 25 * channels)} AS w) k
        GROUP BY x.date, o.r, o.c, f.f) s GROUP BY date, r // 2, c // 2, f"""


def _dense_sql(source: str, fan_in: int, units: int) -> str:
    """Dense layer with bias 0.1 and ReLU on (date, i, v)."""
    return f"""SELECT date, j AS i, greatest(sum(v * {_layer_sql("i", "j", fan_in)}) + 0.1, 0) AS v
        FROM {source} CROSS JOIN (SELECT unnest(range({units})) AS j) u GROUP BY date, j"""


_NETWORK = f"""net_in AS (SELECT date, grid_row AS r, grid_col AS c, 2 * (slot - 1) + chan AS ch, value AS v FROM tensor),
net_1 AS MATERIALIZED ({_conv_sql("net_in", 4, 96, 16)}),
net_2 AS MATERIALIZED ({_conv_sql("net_1", 2, 16, 32)}),
net_flat AS (SELECT date, ch AS i, v FROM net_2),
net_grid AS MATERIALIZED ({_dense_sql("net_flat", 32, 128)}),
net_attr AS (SELECT date, i, value AS v FROM others),
net_others AS MATERIALIZED ({_dense_sql("net_attr", 19, 128)}),
net_both AS (SELECT date, i, v FROM net_grid UNION ALL SELECT date, i + 128, v FROM net_others),
net_out AS ({_dense_sql("net_both", 256, 64)})"""


@query(with_ctes("tensor others", """SELECT date, label, CAST(i AS INTEGER) AS i, round(v, 4) AS value
    FROM net_out JOIN days USING (date)""", _NETWORK))
def extract_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract_features_op(event_days(spark, sf_dir), SPEC, net_weights())
    long = out.select("date", "label", F.posexplode("features").alias("i", "value"))
    return long.select(key(), "label", "i", r("value", 4))


_EXTRACTED_FIT = f"""{_NETWORK},
net_drawn AS MATERIALIZED (SELECT date, i, v, CAST(label AS DOUBLE) AS y,
        {uniform_sql('split', "strftime(strptime(date, '%Y%m%d'), '%Y-%m-%d')")} < 0.8 AS is_train
        FROM net_out JOIN days USING (date)),
net_stats AS (SELECT i, avg(v) AS mean, stddev_samp(v) AS std FROM net_drawn WHERE is_train GROUP BY i),
net_rows AS MATERIALIZED (SELECT date, y, is_train,
        list(CASE WHEN std > 0 THEN (v - mean) / std ELSE 0 END ORDER BY i) AS f
        FROM net_drawn JOIN net_stats USING (i) GROUP BY date, y, is_train),
net_train AS MATERIALIZED (SELECT date, y, f FROM net_rows WHERE is_train),
{descent_sql("net_train", 64, models.L2_REG, "net_fit", 800, 0.0624, 0.95)},
counts AS (SELECT count(*) FILTER (WHERE hit AND y = 1) AS tp, count(*) FILTER (WHERE hit AND y = 0) AS fp,
        count(*) FILTER (WHERE NOT hit AND y = 0) AS tn, count(*) FILTER (WHERE NOT hit AND y = 1) AS fn
        FROM (SELECT y, list_inner_product(w, f) > 0 AS hit FROM net_rows CROSS JOIN net_fit WHERE NOT is_train) h)"""


@query(with_ctes("tensor others", f"""SELECT 'logistic_l2' AS model, round({_HARD_AUC}, 6) AS auc, round({_ACCURACY}, 6) AS recall,
    round({_ACCURACY}, 6) AS precision, round({_ACCURACY}, 6) AS f1, (SELECT count(*) FROM net_train) AS n_train,
    tp + fp + tn + fn AS n_test FROM counts""", _EXTRACTED_FIT))
def features_then_logreg(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = classify.classify_extracted(
        event_days(spark, sf_dir), SPEC, net_weights(), kind=2, iterations=1000, seed=SEED
    )
    return report.select("model", r("auc"), r("recall"), r("precision"), r("f1"), "n_train", "n_test")


_RESTORED = f"""all_rows AS MATERIALIZED (SELECT vec_id, CAST(label AS DOUBLE) AS y, list((x - mean) / std ORDER BY i) AS f
        FROM vec_long JOIN stats USING (i) GROUP BY vec_id, label),
{descent_sql("all_rows", WIDTH, 0.0, "linear", rate=0.7, logistic=False)},
{descent_sql("all_rows", WIDTH, models.L2_REG, "ridge")},
{descent_sql("all_rows", WIDTH, 0.0, "plain")}"""


@query(with_ctes("stats", """SELECT restored, vec_id, round(list_inner_product(w, f), 3) + 0.0 AS score
    FROM all_rows CROSS JOIN (SELECT 'latest' AS restored, w FROM linear UNION ALL SELECT 'oldest', w FROM ridge
    UNION ALL SELECT '2000', w FROM plain) kept""", _RESTORED))
def checkpoint_restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every step has another model; each choice must give back the scores of its own. Step 500 is retired."""
    points = vector_points(spark, sf_dir)
    ridge, plain, linear = (models.fit_classifier(points, kind, 1000) for kind in (2, 3, 1))
    registry = ModelRegistry(spark, shared_dir(spark, "models"), keep=3)
    for step, fitted in ((500, plain), (1000, ridge), (2000, plain), (3000, linear)):
        registry.save(fitted, step)
    scored = [
        models.predict(registry.restore(choice), points).select(
            F.lit(str(choice)).alias("restored"), "vec_id", (F.round("score", 3) + 0.0).alias("score")
        )
        for choice in ("latest", "oldest", 2000)
    ]
    return reduce(DataFrame.unionByName, scored)


# -- losses and metrics --------------------------------------------------------------------------


@query(with_ctes("pred", """SELECT round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
    count(*) AS n_rows FROM pred"""))
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.accuracy(predictions(spark, sf_dir)).select(r("accuracy"), "n_rows")


def _probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    margin = (F.col("score") - 1000) / 1000
    return predictions(spark, sf_dir).select(
        scoring.softmax(F.array(margin, F.lit(0.0))).alias("p"),
        F.array(F.col("label"), 1 - F.col("label")).alias("y"),
    )


_CE_SQL = """SELECT -sum(label * ln(p + 1e-10) + (1 - label) * ln(q + 1e-10)) AS cross_entropy
    FROM (SELECT label, CASE WHEN m > 0 THEN 1 / (1 + exp(-m)) ELSE exp(m) / (1 + exp(m)) END AS p,
    CASE WHEN m > 0 THEN exp(-m) / (1 + exp(-m)) ELSE 1 / (1 + exp(m)) END AS q
    FROM (SELECT label, (score - 1000) / 1000 AS m FROM pred) a) b"""


@query(with_ctes("pred", f"SELECT round(cross_entropy, 4) AS cross_entropy FROM ({_CE_SQL}) c"))
def cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.cross_entropy(_probabilities(spark, sf_dir), "p", "y").select(r("cross_entropy", 4))


_L2_SQL = """SELECT sum(x * x) / 2 * (10.0 / CAST(count(DISTINCT vec_id) AS DOUBLE)) AS l2_penalty
    FROM vec_long"""


def _penalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings as a weights table, scale 10 / number of rows."""
    stored = vectors(spark, sf_dir)
    weights = stored.select("vec_id", F.posexplode("features").alias("i", "w"))
    scale = F.lit(10.0) / stored.agg(F.count(F.lit(1)).cast("double")).scalar()
    return metrics.l2_penalty(weights, scale)


@query(with_ctes("vec_long", f"SELECT round(l2_penalty, 6) AS l2_penalty FROM ({_L2_SQL}) p"))
def l2_penalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _penalty(spark, sf_dir).select(r("l2_penalty"))


@query(with_ctes("pred vec_long", f"""SELECT round(cross_entropy, 4) AS cross_entropy, round(l2_penalty, 6) AS l2_penalty,
    round(cross_entropy + l2_penalty, 4) AS total_loss FROM ({_CE_SQL}) c CROSS JOIN ({_L2_SQL}) p"""))
def total_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    loss = metrics.cross_entropy(_probabilities(spark, sf_dir), "p", "y")
    return metrics.total_loss(loss, _penalty(spark, sf_dir)).select(
        r("cross_entropy", 4), r("l2_penalty"), r("total_loss", 4)
    )


@query(with_ctes("counts", f"SELECT round({_HARD_AUC}, 6) AS auc FROM counts"))
def auc_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.auc_hard(predictions(spark, sf_dir)).select(r("auc"))


@query(with_ctes("pred", """SELECT round((sum(rk) FILTER (WHERE label = 1) - p * (p + 1) / 2) / (p * n), 6) AS auc
    FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rk FROM pred) r
    CROSS JOIN (SELECT CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS p,
                       CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) AS n FROM pred) c GROUP BY p, n"""))
def auc_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = metrics.auc_score(predictions(spark, sf_dir))
    return spark.createDataFrame([(value,)], "auc DOUBLE").select(r("auc"))


@query(with_ctes("counts", """SELECT 0 AS label, tn AS predicted_0, fp AS predicted_1 FROM counts
    UNION ALL SELECT 1, fn, tp FROM counts"""))
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(predictions(spark, sf_dir))


@query(with_ctes("counts", f"""SELECT round({_ACCURACY}, 6) AS precision, round({_ACCURACY}, 6) AS recall,
    round({_ACCURACY}, 6) AS f1 FROM counts"""))
def prf_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.prf_overall(predictions(spark, sf_dir)).select(r("precision"), r("recall"), r("f1"))


@query(with_ctes("counts", """SELECT class, support, round(precision, 6) AS precision, round(recall, 6) AS recall,
    round(f1, 6) AS f1 FROM (SELECT * FROM per_class UNION ALL
    SELECT 'weighted', CAST(sum(support) AS BIGINT), sum(precision * support) / sum(support),
    sum(recall * support) / sum(support), sum(f1 * support) / sum(support) FROM per_class) x""",
    """per_class AS (SELECT '0' AS class, tn + fp AS support, tn / CAST(tn + fn AS DOUBLE) AS precision,
        tn / CAST(tn + fp AS DOUBLE) AS recall, 2 * tn / CAST(2 * tn + fn + fp AS DOUBLE) AS f1 FROM counts
        UNION ALL SELECT '1', tp + fn, tp / CAST(tp + fp AS DOUBLE), tp / CAST(tp + fn AS DOUBLE),
        2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) FROM counts)"""))
def prf_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.prf_per_class(predictions(spark, sf_dir)).select(
        "class", "support", r("precision"), r("recall"), r("f1")
    )


@query(with_ctes("counts", f"""SELECT round({_HARD_AUC}, 6) AS auc, round({_ACCURACY}, 6) AS recall,
    round({_ACCURACY}, 6) AS precision, round({_ACCURACY}, 6) AS f1, tp + fp + tn + fn AS n_rows FROM counts"""))
def metric_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.metric_report(predictions(spark, sf_dir)).select(
        r("auc"), r("recall"), r("precision"), r("f1"), "n_rows"
    )
