"""Queries: scans, sinks, projections, joins, slot quality, day tensors."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmosaic.catalog.registry import query
from flowmosaic.catalog.sql import JITTERED, JITTERED_OTHERS, weight_sql, with_ctes
from flowmosaic.catalog.tables import (
    SEED,
    SPEC,
    event_cells,
    event_days,
    event_flow,
    event_weather,
    predictions,
    vectors,
    weight_column,
)
from flowmosaic.functions import arrays, calendar, scoring
from flowmosaic.operators import align, grid, quality
from flowmosaic.operators.augment import augment_days
from flowmosaic.operators.features import concat_features, labeled_points, linear_score
from flowmosaic.plans.days import day_totals as day_totals_plan
from flowmosaic.schema import WEATHER_CLASSES, GridSpec
from flowmosaic.session import shared_dir
from flowmosaic.sources import registry, scans, sinks

CELL = ["slot", "grid_row", "grid_col"]


def key(column: str = "date") -> Column:
    """Dates leave a query as yyyyMMdd text."""
    return calendar.date_text(F.col(column)).alias(column)


def r(column: str, digits: int = 6, out: str | None = None) -> Column:
    return F.round(F.col(column), digits).alias(out or column)


def checksum(values: str) -> list[Column]:
    """Size, sum and position-weighted sum of an array column."""
    numbered = F.transform(values, lambda x, i: x * (i + 1))
    def add(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x)
    return [
        F.size(values).alias("n_values"),
        F.round(add(F.col(values)), 4).alias("value_sum"),
        F.round(add(numbered), 4).alias("weighted_sum"),
    ]


# -- scans and sinks -----------------------------------------------------------------------------


@query(with_ctes("flow", """SELECT date, slot, grid_row, grid_col,
    round(inflow, 4) AS inflow, round(outflow, 4) AS outflow FROM flow"""))
def scan_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "flow")
    sinks.write_flow(event_flow(spark, sf_dir), path)
    return scans.scan_flow(spark, path).select(key(), *CELL, r("inflow", 4), r("outflow", 4))


@query(with_ctes("weather", "SELECT date, slot, temperature, windspeed, weather_code FROM weather"))
def scan_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "weather")
    event_weather(spark, sf_dir).write.mode("overwrite").parquet(path)
    return scans.scan_weather(spark, path).select(
        key(), "slot", "temperature", "windspeed", "weather_code"
    )


_RAW_SQL = with_ctes(
    "tensor others",
    """SELECT f.*, temperature, windspeed, weather_code
    FROM flow_sums f LEFT JOIN first_others USING (date)""",
    """flow_sums AS (SELECT date, label, CAST(count(*) AS INTEGER) AS n_values, round(sum(value), 4) AS value_sum,
        round(sum(value * (pos + 1)), 4) AS weighted_sum FROM tensor GROUP BY date, label),
    first_others AS (SELECT date, round(max(value) FILTER (WHERE i = 0), 6) AS temperature,
        round(max(value) FILTER (WHERE i = 1), 6) AS windspeed,
        max(i) FILTER (WHERE i >= 2 AND value = 1) - 2 AS weather_code FROM others GROUP BY date)""",
)


def _raw_summary(days: DataFrame) -> DataFrame:
    code = arrays.weather_code(F.slice("others", 3, len(WEATHER_CLASSES)).cast("array<int>"))
    return days.select(
        key(),
        "label",
        *checksum("flow"),
        F.round(F.element_at("others", 1), 6).alias("temperature"),
        F.round(F.element_at("others", 2), 6).alias("windspeed"),
        code.alias("weather_code"),
    )


@query(_RAW_SQL)
def scan_raw_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "raw-days")
    sinks.write_raw_days(event_days(spark, sf_dir), path)
    return _raw_summary(scans.scan_raw_days(spark, path))


_GENERATED = f"""{JITTERED},
{JITTERED_OTHERS},
flow_sums AS (SELECT date, label, batch, count(*) AS n_flow, sum(value) AS flow_sum, sum(value * (pos + 1)) AS flow_weighted
        FROM jittered GROUP BY date, label, batch),
other_sums AS (SELECT date, batch, count(*) AS n_others, sum(value) AS others_sum, sum(value * (i + 1)) AS others_weighted
        FROM jittered_others GROUP BY date, batch),
generated AS (SELECT * FROM flow_sums LEFT JOIN other_sums USING (date, batch) JOIN batches USING (batch))"""


def _generated_sums(generated: DataFrame) -> DataFrame:
    """Sizes, sums and position-weighted sums of both arrays of every generated day."""
    def add(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x)

    def sums(name: str) -> list[Column]:
        numbered = F.transform(name, lambda x, i: x * (i + 1))
        return [
            F.size(name).alias(f"n_{name}"),
            add(F.col(name)).alias(f"{name}_sum"),
            add(numbered).alias(f"{name}_weighted"),
        ]

    return generated.select("source_date", "batch", "limit", "label", *sums("flow"), *sums("others"))


@query(with_ctes("tensor others batches", """SELECT date AS source_date, CAST(batch AS INTEGER) AS batch,
    lim AS "limit", label, CAST(n_flow AS INTEGER) AS n_flow, CAST(n_others AS INTEGER) AS n_others,
    round(flow_sum, 4) AS flow_sum, round(flow_weighted, 4) AS flow_weighted,
    round(others_sum, 4) AS others_sum, round(others_weighted, 4) AS others_weighted FROM generated""", _GENERATED))
def scan_gen_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "gen-days")
    sinks.write_gen_days(augment_days(event_days(spark, sf_dir), SEED), path)
    return _generated_sums(scans.scan_gen_days(spark, path)).select(
        key("source_date"), "batch", "limit", "label", "n_flow", "n_others",
        *[r(c, 4) for c in ("flow_sum", "flow_weighted", "others_sum", "others_weighted")],
    )


@query(_RAW_SQL)
def sink_raw_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second write must replace the first."""
    path = shared_dir(spark, "raw-sink")
    days = event_days(spark, sf_dir)
    sinks.write_raw_days(days.withColumn("label", F.lit(-1)), path)
    sinks.write_raw_days(days, path)
    return _raw_summary(scans.scan_raw_days(spark, path))


@query(with_ctes("tensor others batches", """SELECT CAST(batch AS INTEGER) AS batch, max(lim) AS "limit",
    count(*) AS n_days, CAST(sum(label) AS BIGINT) AS n_weekend, round(sum(flow_sum), 3) AS flow_sum,
    round(sum(flow_weighted), 2) AS flow_weighted, round(sum(others_sum), 3) AS others_sum,
    round(sum(others_weighted), 2) AS others_weighted FROM generated GROUP BY batch""", _GENERATED))
def sink_gen_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "gen-sink")
    generated = augment_days(event_days(spark, sf_dir), SEED)
    sinks.write_gen_days(generated.withColumn("label", F.lit(-1)), path)
    sinks.write_gen_days(generated, path)
    return (
        _generated_sums(scans.scan_gen_days(spark, path))
        .groupBy("batch")
        .agg(
            F.max("limit").alias("limit"),
            F.count(F.lit(1)).alias("n_days"),
            F.sum("label").alias("n_weekend"),
            F.round(F.sum("flow_sum"), 3).alias("flow_sum"),
            F.round(F.sum("flow_weighted"), 2).alias("flow_weighted"),
            F.round(F.sum("others_sum"), 3).alias("others_sum"),
            F.round(F.sum("others_weighted"), 2).alias("others_weighted"),
        )
    )


_LEGEND_SQL = ", ".join(f"({code}, '{name}')" for code, name in enumerate(WEATHER_CLASSES))


@query(with_ctes("weather", f"""SELECT CAST(code AS INTEGER) AS weather_code, name AS weather,
    count(slot) AS n_slots FROM (VALUES {_LEGEND_SQL}) legend(code, name)
    LEFT JOIN weather ON weather_code = code GROUP BY code, name"""))
def local_to_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weather legend as local rows, joined to the readings of every class."""
    legend = scans.local_rows(
        spark, list(enumerate(WEATHER_CLASSES)), "weather_code INT, weather STRING"
    )
    readings = event_weather(spark, sf_dir).groupBy("weather_code").agg(F.count("slot").alias("n_slots"))
    return legend.join(readings, "weather_code", "left").select(
        "weather_code", "weather", F.coalesce("n_slots", F.lit(0)).alias("n_slots")
    )


@query("""SELECT event_type AS model, event_id AS step, concat(event_type, '-', event_id) AS path,
    CASE WHEN nth = 1 THEN 1 ELSE 0 END AS is_latest FROM (SELECT event_type, event_id,
        row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS nth FROM events) e
    WHERE nth <= 5""")
def checkpoint_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a saved step of the model named by its type; the newest five stay."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    manifest = events.select(
        F.col("event_type").alias("model"),
        F.col("event_id").alias("step"),
        F.concat_ws("-", "event_type", "event_id").alias("path"),
    )
    return registry.retained(manifest).select("model", "step", "path", "is_latest")


# -- slot keys, labels, weather vectors ----------------------------------------------------------


@query(with_ctes("flow", """SELECT DISTINCT concat(date, lpad(CAST(slot AS VARCHAR), 2, '0')) AS slot_key,
    date, slot FROM flow"""))
def parse_slot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = calendar.encode_key(F.col("date"), F.col("slot"))
    stored = event_cells(spark, sf_dir).select(F.encode(text, "UTF-8").alias("bytes")).distinct()
    decoded = stored.select(calendar.decode_key(F.col("bytes")).alias("slot_key"))
    return decoded.select(
        "slot_key",
        calendar.date_text(calendar.key_date(F.col("slot_key"))).alias("date"),
        calendar.key_slot(F.col("slot_key")).alias("slot"),
    )


def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_cells(spark, sf_dir).select("date").distinct()


_DATES_SQL = """SELECT date, isodow(strptime(date, '%Y%m%d')) >= 6 AS weekend
    FROM (SELECT DISTINCT date FROM flow) d"""


@query(with_ctes("flow", f"SELECT date, CAST(weekend AS INTEGER) AS is_weekend FROM ({_DATES_SQL}) x"))
def weekend_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates(spark, sf_dir).select(
        key(), calendar.weekend_label(F.col("date")).alias("is_weekend")
    )


@query(with_ctes("flow", f"""SELECT date, CASE WHEN weekend THEN '1,0' ELSE '0,1' END AS onehot
    FROM ({_DATES_SQL}) x"""))
def label_onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    onehot = calendar.label_onehot(calendar.weekend_label(F.col("date")))
    return _dates(spark, sf_dir).select(
        key(), F.array_join(onehot.cast("array<string>"), ",").alias("onehot")
    )


@query(with_ctes("flow", f"SELECT date, CAST(weekend AS INTEGER) AS label FROM ({_DATES_SQL}) x"))
def label_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    onehot = calendar.label_onehot(calendar.weekend_label(F.col("date")))
    return _dates(spark, sf_dir).select(key(), calendar.label_scalar(onehot).alias("label"))


@query(with_ctes("flow weather", """SELECT date, slot, grid_row, grid_col, round(inflow / 100, 6) AS inflow,
    round(outflow / 100, 6) AS outflow, round(temperature / 10, 6) AS temperature,
    round(windspeed / 10, 6) AS windspeed FROM flow JOIN weather USING (date, slot)"""))
def scale_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    flow = grid.scale_flow(event_flow(spark, sf_dir))
    weather = grid.scale_weather(event_weather(spark, sf_dir))
    return flow.join(weather, ["date", "slot"]).select(
        key(), *CELL, r("inflow"), r("outflow"), r("temperature"), r("windspeed")
    )


@query(with_ctes("weather", """SELECT date, slot, array_to_string(list_transform(range(17),
    lambda i: CASE WHEN i = weather_code THEN '1' ELSE '0' END), ',') AS onehot FROM weather"""))
def weather_onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    onehot = arrays.as_int_array(
        arrays.weather_onehot(F.col("weather_code")).cast("array<double>")
    )
    return event_weather(spark, sf_dir).select(
        key(), "slot", F.array_join(onehot.cast("array<string>"), ",").alias("onehot")
    )


@query(with_ctes("weather", f"""SELECT date, slot, weather_code, name AS weather
    FROM weather JOIN (VALUES {_LEGEND_SQL}) legend(code, name) ON code = weather_code"""))
def weather_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = event_weather(spark, sf_dir).select(
        "date", "slot", arrays.weather_onehot(F.col("weather_code")).alias("onehot")
    )
    coded = stored.select("date", "slot", arrays.weather_code(F.col("onehot")).alias("weather_code"))
    return coded.select(
        key(), "slot", "weather_code", arrays.weather_name(F.col("weather_code")).alias("weather")
    )


@query(with_ctes("weather", """SELECT date, slot, CAST(i.v AS INTEGER) AS i,
    CASE i.v WHEN 0 THEN round(temperature / 10, 6) WHEN 1 THEN round(windspeed / 10, 6)
         ELSE CAST(weather_code = i.v - 2 AS DOUBLE) END AS value
    FROM weather CROSS JOIN (SELECT unnest(range(19)) AS v) i"""))
def others_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = grid.scale_weather(event_weather(spark, sf_dir))
    onehot = arrays.weather_onehot(F.col("weather_code"))
    others = arrays.others_vector(F.col("temperature"), F.col("windspeed"), onehot)
    return scaled.select("date", "slot", F.posexplode(others).alias("i", "value")).select(
        key(), "slot", "i", r("value")
    )


# -- layouts of a day ----------------------------------------------------------------------------


def _complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow of complete days; the gate reads the raw observations, not the summed flow."""
    return quality.complete_day_rows(
        event_flow(spark, sf_dir), SPEC.slots, event_cells(spark, sf_dir)
    )


@query(with_ctes("tensor", """SELECT date, CAST(grid_row AS INTEGER) AS grid_row,
    CAST(grid_col AS INTEGER) AS grid_col, CAST(2 * (slot - 1) + chan AS INTEGER) AS chan,
    round(value, 6) AS value FROM tensor"""))
def interleave_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = grid.scale_flow(_complete(spark, sf_dir))
    series = grid.collect_dense(
        scaled, ["date", "grid_row", "grid_col"], F.col("slot") - 1, [F.col("inflow")], SPEC.slots,
        "first", [F.array_sort(F.collect_list(F.struct((F.col("slot") - 1).alias("pos"), F.col("outflow").alias("v1")))).alias("_out")],
    ).withColumn("second", grid.fill_positions(F.col("_out"), SPEC.slots, 1))
    mixed = arrays.interleave(F.col("first"), F.col("second"))
    filled = series.select("date", "grid_row", "grid_col", F.posexplode(mixed).alias("chan", "value"))
    # Cells without a single row that day are zeros as well: take them from the day's cell grid.
    cells = _all_cells(series.select("date").distinct())
    blank = cells.join(series, ["date", "grid_row", "grid_col"], "left_anti").select(
        "date", "grid_row", "grid_col",
        F.posexplode(F.array_repeat(F.lit(0.0), SPEC.channels)).alias("chan", "value"),
    )
    return filled.unionByName(blank).select(key(), "grid_row", "grid_col", "chan", r("value"))


def _all_cells(dates: DataFrame) -> DataFrame:
    cell = F.explode(F.sequence(F.lit(0), F.lit(SPEC.cells - 1))).alias("cell")
    row, col, _ = arrays.unflatten(F.col("cell"), SPEC.cols, 1)
    return dates.select("date", cell).select("date", row.alias("grid_row"), col.alias("grid_col"))


@query(with_ctes("flow complete", """SELECT date, grid_row, grid_col, CAST(2 * m AS INTEGER) AS pos, round(inflow, 4) AS value FROM triples
    UNION ALL SELECT date, grid_row, grid_col, CAST(2 * m + 1 AS INTEGER), round(outflow, 4) FROM triples""",
    """triples AS (SELECT date, grid_row, grid_col, inflow, outflow,
        row_number() OVER (PARTITION BY date, grid_row, grid_col ORDER BY slot) - 1 AS m
        FROM flow JOIN complete USING (date))"""))
def select_inout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From an (in, out, net) layout keep in and out."""
    layered = grid.net_flow(_complete(spark, sf_dir)).groupBy("date", "grid_row", "grid_col").agg(
        F.array_sort(F.collect_list(F.struct("slot", F.array("inflow", "outflow", "net").alias("v")))).alias("s")
    )
    triples = F.flatten(F.transform("s", lambda e: e["v"]))
    kept = arrays.stride_channels(triples, 3, (0, 1))
    return layered.select("date", "grid_row", "grid_col", F.posexplode(kept).alias("pos", "value")).select(
        key(), "grid_row", "grid_col", "pos", r("value", 4)
    )


@query(with_ctes("flow", """SELECT date, slot, grid_row, grid_col,
    round(inflow - outflow, 4) + 0.0 AS net FROM flow"""))
def net_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.net_flow(event_flow(spark, sf_dir)).select(
        key(), *CELL, (F.round("net", 4) + 0.0).alias("net")
    )


_TENSOR_SQL = with_ctes("tensor", "SELECT date, pos, round(value, 6) AS value FROM tensor")


def _tensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.day_tensor(grid.scale_flow(event_flow(spark, sf_dir)), SPEC, unique=True)


@query(_TENSOR_SQL)
def day_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = _tensors(spark, sf_dir).select("date", F.posexplode("flow").alias("pos", "value"))
    return long.select(key(), "pos", r("value"))


@query(_TENSOR_SQL)
def flatten_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = _tensors(spark, sf_dir).select("date", arrays.nest_tensor(F.col("flow"), SPEC).alias("grid"))
    flat = nested.select(
        "date", F.posexplode(arrays.flatten_tensor(F.col("grid"))).alias("pos", "value")
    )
    return flat.select(key(), "pos", r("value"))


@query(with_ctes("tensor", """SELECT date, pos, CAST(grid_row AS INTEGER) AS grid_row,
    CAST(grid_col AS INTEGER) AS grid_col, CAST(2 * (slot - 1) + chan AS INTEGER) AS chan,
    round(value, 6) AS value FROM tensor"""))
def reshape_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = _tensors(spark, sf_dir).select("date", F.posexplode("flow").alias("pos", "value"))
    row, col, chan = arrays.unflatten(F.col("pos"), SPEC.cols, SPEC.channels)
    return long.select(
        key(), "pos", row.alias("grid_row"), col.alias("grid_col"), chan.alias("chan"), r("value")
    )


_RECORD_SQL = """record AS (SELECT date, pos, value FROM tensor
    UNION ALL SELECT date, 1536 + i, value FROM others
    UNION ALL SELECT date, 1555, CAST(label AS DOUBLE) FROM days)"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_days(spark, sf_dir).select(
        "date",
        arrays.assemble_record(F.col("flow"), F.col("others"), F.col("label")).alias("record"),
    )


@query(with_ctes("tensor others", "SELECT date, pos, round(value, 6) AS value FROM record", _RECORD_SQL))
def assemble_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = _records(spark, sf_dir).select("date", F.posexplode("record").alias("pos", "value"))
    return long.select(key(), "pos", r("value"))


@query(with_ctes("tensor others", """SELECT date, CAST(count(*) FILTER (WHERE pos < 1555) AS INTEGER) AS n_values,
    round(sum(value) FILTER (WHERE pos < 1555), 4) AS value_sum,
    round(sum(value * (pos + 1)) FILTER (WHERE pos < 1555), 4) AS weighted_sum,
    max(value) FILTER (WHERE pos = 1555) AS label FROM record GROUP BY date""",
    _RECORD_SQL))
def split_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = _records(spark, sf_dir).select(
        "date",
        arrays.record_features(F.col("record")).alias("features"),
        arrays.record_label(F.col("record")).alias("label"),
    )
    return split.select(key(), *checksum("features"), "label")


@query(with_ctes("vec_long", """SELECT vec_id, CAST(label AS DOUBLE) AS label, i, round(x, 6) AS value
    FROM vec_long"""), name="labeled_points")
def labeled_points_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = labeled_points(vectors(spark, sf_dir), "vec_id")
    return points.select(
        "vec_id", "label", F.posexplode(vector_to_array("features")).alias("i", "value")
    ).select("vec_id", "label", "i", r("value"))


# -- scores --------------------------------------------------------------------------------------


@query(with_ctes("pred", """SELECT doc_id, CASE WHEN score - 1000 > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
    FROM pred"""))
def threshold_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = predictions(spark, sf_dir)
    return scored.select("doc_id", scoring.threshold(F.col("score") - 1000).alias("prediction"))


@query(with_ctes("vec", """SELECT vec_id, CAST(list_position(features, list_max(features)) - 1 AS INTEGER) AS class
    FROM vec"""))
def argmax_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).select("vec_id", scoring.argmax(F.col("features")).alias("class"))


@query(with_ctes("vec_long", "SELECT vec_id, i, round(greatest(x, 0.0), 6) AS value FROM vec_long"))
def relu(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = vectors(spark, sf_dir).select(
        "vec_id", F.posexplode(scoring.relu_array(F.col("features"))).alias("i", "value")
    )
    return long.select("vec_id", "i", r("value"))


@query(with_ctes("vec_long", """SELECT vec_id, round(1 / (1 + exp(z1 - z0)), 6) AS p0, round(1 / (1 + exp(z0 - z1)), 6) AS p1 FROM z""",
    f"""z AS (SELECT vec_id, sum(x * {weight_sql('i', '0')}) AS z0,
        sum(x * {weight_sql('i', '1')}) AS z1 FROM vec_long GROUP BY vec_id)"""))
def softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = F.array(*[linear_score(F.col("features"), weight_column(j)) for j in (0, 1)])
    return vectors(spark, sf_dir).select("vec_id", scoring.softmax(scores).alias("p")).select(
        "vec_id",
        F.round(F.col("p")[0], 6).alias("p0"),
        F.round(F.col("p")[1], 6).alias("p1"),
    )


@query(with_ctes("vec_long", """SELECT vec_id, i, round(x, 6) AS value FROM vec_long
    UNION ALL SELECT vec_id, i + 64, round(greatest(x, 0.0), 6) FROM vec_long"""), name="concat_features")
def concat_feature_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = concat_features(F.col("features"), scoring.relu_array(F.col("features")))
    long = vectors(spark, sf_dir).select("vec_id", F.posexplode(both).alias("i", "value"))
    return long.select("vec_id", "i", r("value"))


# -- day gate and joins --------------------------------------------------------------------------


@query(with_ctes("complete", "SELECT date FROM complete"))
def complete_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.complete_days(event_cells(spark, sf_dir), SPEC.slots).select(key())


@query(with_ctes("flow complete", """SELECT date, slot, grid_row, grid_col, round(inflow, 4) AS inflow,
    round(outflow, 4) AS outflow FROM flow SEMI JOIN complete USING (date)"""))
def complete_day_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _complete(spark, sf_dir).select(key(), *CELL, r("inflow", 4), r("outflow", 4))


@query(with_ctes("flow complete", """SELECT date, count(DISTINCT slot) AS n_slots, count(*) AS n_rows
    FROM flow ANTI JOIN complete USING (date) GROUP BY date"""))
def incomplete_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = quality.incomplete_day_rows(
        event_flow(spark, sf_dir), SPEC.slots, event_cells(spark, sf_dir)
    )
    per_slot = rejected.groupBy("date", "slot").agg(F.count(F.lit(1)).alias("n"))
    return per_slot.groupBy("date").agg(
        F.count(F.lit(1)).alias("n_slots"), F.sum("n").alias("n_rows")
    ).select(key(), "n_slots", "n_rows")


@query(with_ctes("flow weather", """SELECT date, slot, grid_row, grid_col, round(inflow, 4) AS inflow,
    round(outflow, 4) AS outflow, coalesce(temperature, -999) AS temperature,
    coalesce(windspeed, -999) AS windspeed, coalesce(weather_code, -1) AS weather_code,
    CASE WHEN weather_code IS NULL THEN 0 ELSE 1 END AS has_weather
    FROM flow LEFT JOIN weather USING (date, slot)"""))
def align_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align.align_weather(event_flow(spark, sf_dir), event_weather(spark, sf_dir))
    return aligned.select(
        key(), *CELL, r("inflow", 4), r("outflow", 4),
        F.coalesce("temperature", F.lit(-999.0)).alias("temperature"),
        F.coalesce("windspeed", F.lit(-999.0)).alias("windspeed"),
        F.coalesce("weather_code", F.lit(-1)).alias("weather_code"),
        "has_weather",
    )


@query(with_ctes("flow weather", """SELECT DISTINCT date, slot FROM flow ANTI JOIN weather USING (date, slot)"""))
def unmatched_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    missed = align.unmatched_slots(event_cells(spark, sf_dir), event_weather(spark, sf_dir))
    return missed.select(key(), "slot")


@query("""SELECT doc_id, CAST(quality AS DOUBLE) AS label, CAST(n_chars AS DOUBLE) AS n_chars,
    CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS n_spaces FROM documents JOIN labels USING (doc_id)""")
def zip_features_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the documents and the labels from their own table, paired by id."""
    spaces = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))
    features = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", F.array(F.col("n_chars").cast("double"), spaces.cast("double")).alias("features")
    )
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(
        "doc_id", F.col("quality").cast("double").alias("label")
    )
    return align.zip_by_key(features, labels, "doc_id").select(
        "doc_id", "label", F.col("features")[0].alias("n_chars"), F.col("features")[1].alias("n_spaces")
    )


@query(with_ctes("pred", "SELECT doc_id, prediction, label FROM pred"))
def predictions_with_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions(spark, sf_dir).select("doc_id", "prediction", "label")


# -- day aggregates ------------------------------------------------------------------------------


@query(with_ctes("flow", """SELECT date, CAST(bit_or(CAST(1 AS BIGINT) << (slot - 1)) AS BIGINT) AS bits,
    CAST(count(DISTINCT slot) AS INTEGER) AS n_slots,
    count(*) FILTER (WHERE slot < 1 OR slot > 48) AS bad_rows FROM flow GROUP BY date"""))
def slot_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    bitmap = quality.slot_bitmap(event_cells(spark, sf_dir), SPEC.slots)
    return bitmap.select(key(), F.col("bits0").alias("bits"), "n_slots", "bad_rows")


@query(with_ctes("cells", """SELECT date, slot, grid_row, grid_col, count(*) AS copies FROM cells
    GROUP BY date, slot, grid_row, grid_col HAVING count(*) > 1"""))
def duplicate_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unsummed observations hold several copies of a cell."""
    return quality.duplicate_cells(event_cells(spark, sf_dir)).select(key(), *CELL, "copies")


@query(with_ctes("cells", """SELECT date, slot, grid_row, grid_col, inflow, outflow FROM (SELECT *,
    row_number() OVER (PARTITION BY date, slot, grid_row, grid_col ORDER BY inflow, outflow) AS nth
    FROM cells) c WHERE nth = 1"""))
def deduplicate_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.deduplicate_cells(event_cells(spark, sf_dir)).select(
        key(), *CELL, "inflow", "outflow"
    )


@query(with_ctes("cells", """SELECT date, count(*) FILTER (WHERE grid_row < 3) AS n_cells,
    CAST(coalesce(sum(copies - 1) FILTER (WHERE grid_row < 3), 0) AS BIGINT) AS n_copies,
    CAST(coalesce(sum(copies) FILTER (WHERE grid_row >= 3), 0) AS BIGINT) AS n_stray
    FROM (SELECT date, slot, grid_row, grid_col, count(*) AS copies FROM cells
          GROUP BY date, slot, grid_row, grid_col) c GROUP BY date"""))
def cell_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against a grid of three rows the observations of the fourth are strays."""
    report = quality.cell_quality(event_cells(spark, sf_dir), GridSpec(3, 4, 30))
    return report.select(key(), "n_cells", "n_copies", "n_stray")


@query(with_ctes("flow", """SELECT date, n_slots, bad_rows, CAST(n_slots = 48 AND bad_rows = 0 AS INTEGER) AS is_complete
    FROM (SELECT date, CAST(count(DISTINCT slot) AS INTEGER) AS n_slots,
          count(*) FILTER (WHERE slot < 1 OR slot > 48) AS bad_rows FROM flow GROUP BY date) d"""))
def day_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.day_quality(event_cells(spark, sf_dir), SPEC.slots)
    return report.select(key(), "n_slots", "bad_rows", "is_complete")


@query(with_ctes("flow", """SELECT date, slot, CAST(row_number() OVER w AS INTEGER) AS position,
    coalesce(lead(slot) OVER w, -1) AS next_slot FROM (SELECT DISTINCT date, slot FROM flow) s
    WINDOW w AS (PARTITION BY date ORDER BY slot)"""))
def slot_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = quality.slot_sequence(event_cells(spark, sf_dir))
    return ordered.select(key(), "slot", "position", "next_slot")


@query(with_ctes("flow weather", """SELECT date, firsts.slot AS first_slot, coalesce(temperature, -999) AS temperature,
    coalesce(windspeed, -999) AS windspeed, coalesce(weather_code, -1) AS weather_code
    FROM firsts LEFT JOIN weather USING (date, slot)""",
    "firsts AS (SELECT date, min(slot) AS slot FROM flow GROUP BY date)"))
def first_slot_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = align.first_slot_attributes(event_cells(spark, sf_dir), event_weather(spark, sf_dir))
    return first.select(
        key(), "first_slot",
        F.coalesce("temperature", F.lit(-999.0)).alias("temperature"),
        F.coalesce("windspeed", F.lit(-999.0)).alias("windspeed"),
        F.coalesce("weather_code", F.lit(-1)).alias("weather_code"),
    )


@query(with_ctes("flow days", """SELECT date, label, count(*) AS n_cells, round(sum(inflow), 4) AS inflow,
    round(sum(outflow), 4) AS outflow FROM flow JOIN days USING (date) GROUP BY date, label"""))
def day_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = day_totals_plan(event_flow(spark, sf_dir), SPEC, unique=True)
    return totals.select(key(), "label", "n_cells", r("inflow", 4), r("outflow", 4))
