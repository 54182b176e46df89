"""Queries: components at full width, gradient descent of the linear kinds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmosaic.catalog.learning_queries import _ACCURACY, _HARD_AUC, _SPLIT_SCALED, _vector_split
from flowmosaic.catalog.registry import query
from flowmosaic.catalog.sql import components_sql, uniform_sql, with_ctes
from flowmosaic.catalog.tables import SEED, WIDTH, event_days
from flowmosaic.catalog.tables_queries import key, r
from flowmosaic.operators import descent, features, wide
from flowmosaic.operators.metrics import metric_report
from flowmosaic.operators.models import L2_REG
from flowmosaic.operators.splits import raw_examples
from flowmosaic.plans import classify

_WIDE = 3

# Whole day tensors and attributes, scaled; inner products of days instead of a covariance.
_DUAL = f"""wide AS MATERIALIZED (SELECT date, pos AS i, value AS x FROM tensor
        UNION ALL SELECT date, 1536 + i, value FROM others SEMI JOIN days USING (date)),
whole AS (SELECT date FROM wide GROUP BY date HAVING count(*) = 1555),
wide_stats AS (SELECT i, avg(x) AS mean, stddev_samp(x) AS std FROM wide SEMI JOIN whole USING (date) GROUP BY i),
z AS MATERIALIZED (SELECT date, i, CASE WHEN std > 0 THEN (x - mean) / std ELSE 0 END AS z
        FROM wide SEMI JOIN whole USING (date) JOIN wide_stats USING (i)),
gram AS MATERIALIZED (SELECT a.date AS i, b.date AS j, sum(a.z * b.z) AS v FROM z a JOIN z b ON a.i = b.i GROUP BY a.date, b.date),
{components_sql("gram", _WIDE, "gc")},
raw_pc AS MATERIALIZED (SELECT c, z.i, sum(z.z * gc.v) / sqrt(any_value(eigenvalue)) AS v FROM z JOIN gc ON gc.i = z.date GROUP BY c, z.i),
pc AS MATERIALIZED (SELECT c, i, v * sign(arg_max(v, abs(v)) OVER (PARTITION BY c)) AS v FROM raw_pc)"""


def _wide_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = classify.flat_points(raw_examples(event_days(spark, sf_dir)))
    return features.fit_scaler(points).transform(points)


@query(with_ctes("tensor others", """SELECT CAST(c AS INTEGER) AS component, CAST(i AS INTEGER) AS i, round(v, 5) + 0.0 AS loading FROM pc""", _DUAL))
def pca_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of whole day tensors, wider than there are days."""
    fitted = wide.fit_wide_pca(_wide_days(spark, sf_dir), "source_date", _WIDE)
    long = fitted.loadings.select("i", F.posexplode("loadings").alias("component", "loading"))
    return long.select("component", "i", (F.round("loading", 5) + 0.0).alias("loading"))


@query(with_ctes("tensor others", """SELECT DISTINCT CAST(c AS INTEGER) AS component,
    round(eigenvalue / (SELECT sum(v) FROM gram WHERE i = j), 6) AS variance_share FROM gc""", _DUAL))
def pca_wide_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = wide.fit_wide_pca(_wide_days(spark, sf_dir), "source_date", _WIDE)
    rows = [(c, v / fitted.total_variance) for c, v in enumerate(fitted.variances)]
    return spark.createDataFrame(rows, "component INT, variance_share DOUBLE").select("component", r("variance_share"))


@query(with_ctes("tensor others", """SELECT date AS source_date, CAST(c AS INTEGER) AS component, round(sum(z * v), 4) + 0.0 AS value
    FROM z JOIN pc USING (i) GROUP BY date, c""", _DUAL))
def pca_wide_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = _wide_days(spark, sf_dir)
    fitted = wide.fit_wide_pca(scaled, "source_date", _WIDE)
    out = wide.project_wide(scaled, "source_date", fitted)
    long = out.select(key("source_date"), F.posexplode("components").alias("component", "value"))
    return long.select("source_date", "component", (F.round("value", 4) + 0.0).alias("value"))


_STEPS, _FRACTION = 40, 0.5


def _descent_sql(kind: str, out: str, fraction: float, l2: float, step: float = 1.0) -> str:
    """CTEs ``{out}_fit`` (t, w, loss, moved) and ``{out}`` (w) over ``train_rows`` (vec_id, y, f)."""
    factor, loss = {
        "squared": ("s - y", "(s - y) * (s - y) / 2"),
        "logistic": ("1 / (1 + exp(-s)) - y", "ln(1 + exp(s)) - y * s"),
        "hinge": ("CASE WHEN (2 * y - 1) * s < 1 THEN 1 - 2 * y ELSE 0 END", "greatest(1 - (2 * y - 1) * s, 0)"),
    }[kind]
    drawn = "" if fraction >= 1 else f"AND {uniform_sql('minibatch', '(t + 1)::VARCHAR', 'vec_id::VARCHAR')} < {fraction}"
    return f"""{out}_fit(t, w, loss, still) AS (
        SELECT 0, CAST(list_transform(range({WIDTH}), lambda k: 0.0) AS DOUBLE[]), CAST(0 AS DOUBLE), false
        UNION ALL
        SELECT t, list(next ORDER BY k), any_value(loss),
            sqrt(sum((next - wk) * (next - wk))) < 1e-3 * greatest(sqrt(sum(next * next)), 1) FROM (
            SELECT t + 1 AS t, k, any_value(w[k + 1]) AS wk,
                   avg({loss}) + {l2} / 2 * any_value(list_inner_product(w, w)) AS loss,
                   any_value(w[k + 1]) * (1 - {step} / sqrt(t + 1) * {l2}) - {step} / sqrt(t + 1) * avg(({factor}) * f[k + 1]) AS next
            FROM (SELECT t, w, f, y, list_inner_product(w, f) AS s FROM {out}_fit CROSS JOIN train_rows
                  WHERE t < {_STEPS} AND NOT still {drawn}) b
            CROSS JOIN (SELECT unnest(range({WIDTH})) AS k) ks GROUP BY t, k) g GROUP BY t),
    {out} AS (SELECT w FROM {out}_fit ORDER BY t DESC LIMIT 1)"""


def _scaled_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    train, test = _vector_split(spark, sf_dir)
    scaler = features.fit_scaler(train)
    return scaler.transform(train), scaler.transform(test)


def _sgd(train: DataFrame, kind: str, fraction: float = _FRACTION, l2: float = L2_REG, step: float = 1.0) -> descent.Descent:
    return descent.fit_descent(train, kind, _STEPS, key="vec_id", features="scaled", fraction=fraction, l2=l2, step=step, seed=SEED)


def _sgd_sql(kind: str) -> str:
    return with_ctes("vec_long", """SELECT vec_id, y AS label, round(list_inner_product(w, f), 4) + 0.0 AS score,
    CASE WHEN list_inner_product(w, f) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
    FROM split_rows CROSS JOIN fit WHERE NOT is_train""", _SPLIT_SCALED + ",\n" + _descent_sql(kind, "fit", _FRACTION, L2_REG))


def _sgd_scores(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    train, test = _scaled_split(spark, sf_dir)
    out = descent.descent_scores(test, _sgd(train, kind), "scaled")
    return out.select("vec_id", "label", (F.round("score", 4) + 0.0).alias("score"), "prediction")


@query(_sgd_sql("hinge"))
def svm_sgd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hinge loss by mini-batch descent."""
    return _sgd_scores(spark, sf_dir, "hinge")


@query(_sgd_sql("logistic"))
def logreg_sgd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sgd_scores(spark, sf_dir, "logistic")


@query(with_ctes("vec_long", """SELECT 'svm' AS model, CAST(t AS INTEGER) AS step, round(loss, 6) AS loss FROM svm_fit WHERE t > 0
    UNION ALL SELECT 'logistic', CAST(t AS INTEGER), round(loss, 6) FROM log_fit WHERE t > 0""",
    f"{_SPLIT_SCALED},\n{_descent_sql('hinge', 'svm', _FRACTION, L2_REG)},\n{_descent_sql('logistic', 'log', _FRACTION, L2_REG)}"))
def sgd_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss of the weights before each step, on that step's rows."""
    train, _ = _scaled_split(spark, sf_dir)
    traces = [
        descent.history_table(train, _sgd(train, kind)).select(F.lit(name).alias("model"), "step", r("loss"))
        for name, kind in (("svm", "hinge"), ("logistic", "logistic"))
    ]
    return reduce(DataFrame.unionByName, traces)


_SGD_KINDS = (("linear", "squared", 0.0, 0.1), ("logistic_l2", "logistic", L2_REG, 1.0), ("svm", "hinge", L2_REG, 1.0))


@query(with_ctes("vec_long", f"""SELECT model, round({_HARD_AUC}, 6) AS auc, round({_ACCURACY}, 6) AS recall,
    round({_ACCURACY}, 6) AS precision, round({_ACCURACY}, 6) AS f1, (SELECT count(*) FROM train_rows) AS n_train,
    tp + fp + tn + fn AS n_test FROM counts""", ",\n".join([
        _SPLIT_SCALED,
        *[_descent_sql(kind, name, 1.0, l2, step) for name, kind, l2, step in _SGD_KINDS],
        f"""judged AS (SELECT model, y = 1 AS truth, list_inner_product(w, f) > 0 AS hit FROM split_rows CROSS JOIN (
        {" UNION ALL ".join(f"SELECT '{name}' AS model, w FROM {name}" for name, *_ in _SGD_KINDS)}) fits WHERE NOT is_train),
counts AS (SELECT model, count(*) FILTER (WHERE hit AND truth) AS tp, count(*) FILTER (WHERE hit AND NOT truth) AS fp,
        count(*) FILTER (WHERE NOT hit AND NOT truth) AS tn, count(*) FILTER (WHERE NOT hit AND truth) AS fn
        FROM judged GROUP BY model)"""])))
def bakeoff_sgd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kinds that were trained by gradient steps, with the whole train part in every step."""
    train, test = _scaled_split(spark, sf_dir)
    n_train, rows = train.count(), []
    for name, kind, l2, step in _SGD_KINDS:
        pairs = descent.descent_scores(test, _sgd(train, kind, 1.0, l2, step), "scaled")
        report = metric_report(pairs.select("label", "prediction"))
        rows.append(report.select(
            F.lit(name).alias("model"), r("auc"), r("recall"), r("precision"), r("f1"),
            F.lit(n_train).cast("bigint").alias("n_train"), F.col("n_rows").alias("n_test"),
        ))
    return reduce(DataFrame.unionByName, rows)
