"""Queries: augmentation, splits, shuffles, bootstrap batches and train/test protocols."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmosaic.catalog.registry import query
from flowmosaic.catalog.sql import JITTERED, fine_uniform_sql, jitter_sql, uniform_sql, with_ctes
from flowmosaic.catalog.tables import SEED, SPEC, event_cells, event_days, event_flow, table
from flowmosaic.catalog.tables_queries import CELL, checksum, key, r
from flowmosaic.functions.calendar import weekend_label
from flowmosaic.operators import splits
from flowmosaic.operators.augment import augment_cells, augment_days, union_batches, with_batches
from flowmosaic.operators.grid import scale_flow
from flowmosaic.operators.quality import complete_day_rows, complete_days
from flowmosaic.schema import AUGMENT_SCHEDULE

# -- augmentation --------------------------------------------------------------------------------

_PAIR = "(grid_row * 4 + grid_col) * 48 + (slot - 1)"
_FLOW_KEY = ("date", "batch", _PAIR)


@query(with_ctes("flow complete batches", f"""SELECT date, CAST(batch AS INTEGER) AS batch, slot, grid_row, grid_col,
    round(inflow / 100 * {jitter_sql(uniform_sql('flow', *_FLOW_KEY), 'lim')}, 6) AS inflow,
    round(outflow / 100 * {jitter_sql(uniform_sql('flow', *_FLOW_KEY, word=1), 'lim')}, 6) AS outflow
    FROM flow JOIN complete USING (date) CROSS JOIN batches"""))
def augment_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    observed = event_cells(spark, sf_dir)
    flow = scale_flow(complete_day_rows(event_flow(spark, sf_dir), SPEC.slots, observed))
    return augment_cells(flow, SPEC, SEED).select(key(), "batch", *CELL, r("inflow"), r("outflow"))


@query(with_ctes("others batches", f"""SELECT date, CAST(batch AS INTEGER) AS batch, i,
    round(value * {jitter_sql(uniform_sql('others', 'date', 'batch', 'i'), 'lim')}, 6) AS value
    FROM others CROSS JOIN batches"""))
def augment_others(spark: SparkSession, sf_dir: str) -> DataFrame:
    generated = augment_days(event_days(spark, sf_dir), SEED)
    long = generated.select("source_date", "batch", F.posexplode("others").alias("i", "value"))
    return long.select(key("source_date").alias("date"), "batch", "i", r("value"))


@query(with_ctes("days batches", """SELECT date, label, CAST(batch AS INTEGER) AS batch, lim AS "limit"
    FROM days CROSS JOIN batches"""))
def augment_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = complete_days(event_cells(spark, sf_dir), SPEC.slots).select(
        "date", weekend_label(F.col("date")).alias("label")
    )
    return with_batches(days).select(key(), "label", "batch", "limit")


@query(with_ctes("tensor batches", """SELECT date, label, CAST(batch AS INTEGER) AS batch,
    CAST(count(*) AS INTEGER) AS n_values, round(sum(value), 4) AS value_sum,
    round(sum(value * (pos + 1)), 4) AS weighted_sum
    FROM jittered GROUP BY date, label, batch""", JITTERED), name="union_batches")
def union_generated_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch generated on its own, then concatenated: same rows as one schedule."""
    days = event_days(spark, sf_dir)
    batches = [augment_days(days, SEED, [step]) for step in AUGMENT_SCHEDULE]
    return union_batches(batches).select(
        key("source_date").alias("date"), "label", "batch", *checksum("flow")
    )


# -- splits, shuffles, draws ---------------------------------------------------------------------


@query(f"""SELECT o_orderkey, CASE WHEN {uniform_sql('split', 'o_orderkey')} < 0.8 THEN 'train'
    ELSE 'test' END AS role FROM orders""")
def split_80_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return splits.split_fraction(orders, ["o_orderkey"], 0.8, SEED)


_SHUFFLE_U = uniform_sql("shuffle", "o_orderkey")


@query(f"""SELECT o_orderkey, row_number() OVER (ORDER BY u, o_orderkey) - 1 AS idx
    FROM (SELECT o_orderkey, {_SHUFFLE_U} AS u FROM orders) o""")
def shuffle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in shuffled order with their exact position in it."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    placed = splits.dense_index(orders, ["o_orderkey"], SEED)
    return placed.orderBy("u", "o_orderkey").select("o_orderkey", "idx")


@query(f"""SELECT o_orderkey, o_totalprice,
    CASE WHEN row_number() OVER (ORDER BY u, o_orderkey) <= floor(count(*) OVER () * 0.8) THEN 'train'
    ELSE 'test' END AS role
    FROM (SELECT o_orderkey, o_totalprice, {_SHUFFLE_U} AS u FROM orders) o""")
def shuffle_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return splits.shuffle_split(orders, ["o_orderkey"], 0.8, SEED)


@query(f"""WITH indexed AS (SELECT vec_id, label, row_number() OVER (ORDER BY u, vec_id) - 1 AS idx
        FROM (SELECT vec_id, label, {uniform_sql('shuffle', 'vec_id')} AS u FROM embeddings) e),
    draws AS (SELECT step, draw, CAST(floor({fine_uniform_sql('bootstrap', 'step', 'draw')} * n) AS BIGINT) AS idx
        FROM (SELECT CAST(id // 32 AS INTEGER) AS step, CAST(id % 32 AS INTEGER) AS draw
              FROM (SELECT unnest(range(3200)) AS id) d) s CROSS JOIN (SELECT count(*) AS n FROM embeddings) c)
    SELECT step, draw, vec_id, label FROM draws JOIN indexed USING (idx)""")
def bootstrap_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundred training steps of 32 draws with replacement."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    drawn = splits.bootstrap_batches(vectors, ["vec_id"], 100, 32, SEED)
    return drawn.select("step", "draw", "vec_id", "label")


# -- protocols -----------------------------------------------------------------------------------

_GEN = "SELECT date AS source_date, CAST(batch AS INTEGER) AS batch, label, '{role}' AS role FROM days CROSS JOIN batches"
_RAW = "SELECT date AS source_date, -1 AS batch, label, '{role}' AS role FROM days"
_PREFIX = f"""SELECT date AS source_date, -1 AS batch, label,
    CASE WHEN row_number() OVER (ORDER BY u, date) <= floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'test' END AS role
    FROM (SELECT date, label, {uniform_sql('shuffle', "strftime(strptime(date, '%Y%m%d'), '%Y-%m-%d')")} AS u FROM days) d"""
_DRAWN = f"""SELECT date, label, {uniform_sql('split', "strftime(strptime(date, '%Y%m%d'), '%Y-%m-%d')")} AS u FROM days"""
_SPLIT_AUG = f"""SELECT date AS source_date, CAST(batch AS INTEGER) AS batch, label, 'train' AS role
    FROM ({_DRAWN}) d CROSS JOIN batches WHERE u < 0.8
    UNION ALL SELECT date, -1, label, 'test' FROM ({_DRAWN}) d WHERE u >= 0.8"""
_AUG_RAW = f"{_GEN.format(role='train')} UNION ALL {_RAW.format(role='test')}"
_RAW_AUG = f"{_RAW.format(role='train')} UNION ALL {_GEN.format(role='test')}"


def _protocols(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    days = event_days(spark, sf_dir)
    augmented = augment_days(days, SEED)
    return {
        "aug_raw": splits.protocol_aug_raw(days, augmented),
        "raw_aug": splits.protocol_raw_aug(days, augmented),
        "raw_split": splits.protocol_raw_split(days, 0.8, SEED),
        "split_augment": splits.protocol_split_augment(days, 0.8, SEED),
    }


def _shown(examples: DataFrame) -> DataFrame:
    return examples.select(key("source_date"), "batch", "label", "role")


@query(with_ctes("days batches", _AUG_RAW))
def protocol_aug_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_protocols(spark, sf_dir)["aug_raw"])


@query(with_ctes("days batches", _RAW_AUG))
def protocol_raw_aug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_protocols(spark, sf_dir)["raw_aug"])


@query(with_ctes("days batches", _PREFIX))
def protocol_raw_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_protocols(spark, sf_dir)["raw_split"])


@query(with_ctes("days batches", _SPLIT_AUG))
def protocol_split_augment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_protocols(spark, sf_dir)["split_augment"])


_PROTOCOL_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS protocol, * FROM ({sql}) p"
    for name, sql in (
        ("aug_raw", _AUG_RAW), ("raw_aug", _RAW_AUG), ("raw_split", _PREFIX), ("split_augment", _SPLIT_AUG),
    )
)


@query(with_ctes("days batches", f"""SELECT protocol, count(*) FILTER (WHERE role = 'train') AS n_train,
    count(*) FILTER (WHERE role = 'test') AS n_test,
    count(*) FILTER (WHERE role = 'test' AND (protocol, source_date) IN
        (SELECT protocol, source_date FROM examples WHERE role = 'train')) AS n_leaked
    FROM (VALUES ('aug_raw'), ('raw_aug'), ('raw_split'), ('split_augment')) names(protocol)
    LEFT JOIN examples USING (protocol) GROUP BY protocol""", f"examples AS ({_PROTOCOL_SQL})"))
def leakage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    audits = [
        splits.leakage_audit(examples).withColumn("protocol", F.lit(name))
        for name, examples in _protocols(spark, sf_dir).items()
    ]
    return union_batches(audits)


@query(f"""SELECT role, count(*) AS n_rows FROM (SELECT CASE WHEN {uniform_sql('split', 'o_orderkey')} < 0.8
    THEN 'train' ELSE 'test' END AS role FROM orders) o GROUP BY role""")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return splits.split_counts(splits.split_fraction(orders, ["o_orderkey"], 0.8, SEED))
