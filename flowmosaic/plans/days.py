"""From slot rows to day sets: gate, align, label, scale, assemble, augment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmosaic.functions.arrays import others_vector, weather_onehot
from flowmosaic.functions.calendar import weekend_label
from flowmosaic.operators.align import earliest_reading
from flowmosaic.operators.augment import augment_days
from flowmosaic.operators.grid import day_tensor, scale_flow, scale_weather
from flowmosaic.operators.quality import deduplicate_cells, gate_aggregates, gate_passed, on_grid
from flowmosaic.schema import GridSpec
from flowmosaic.sources.sinks import write_gen_days, write_raw_days


def day_totals(flow: DataFrame, spec: GridSpec, *, unique: bool = False) -> DataFrame:
    """(date, inflow, outflow, n_cells, label): what each complete day amounts to.

    The gate's aggregates ride along with the sums, so the flow is read once. Cells count as in
    ``clean_cells``: those off the grid add nothing, copies are merged.
    """
    cells = flow if unique else deduplicate_cells(flow)
    inside = on_grid(spec)
    totals = cells.groupBy("date").agg(
        F.coalesce(F.sum(F.when(inside, F.col("inflow"))), F.lit(0.0)).alias("inflow"),
        F.coalesce(F.sum(F.when(inside, F.col("outflow"))), F.lit(0.0)).alias("outflow"),
        F.count(F.when(inside, 1)).alias("n_cells"),
        *gate_aggregates(spec.slots),
    )
    return totals.filter(gate_passed(spec.slots)).select(
        "date", "inflow", "outflow", "n_cells", weekend_label(F.col("date")).alias("label")
    )


def day_others(weather: DataFrame, spec: GridSpec, missing: str = "null") -> DataFrame:
    """(date, others): scaled weather of a complete day's first slot as one vector.

    A complete day has every slot, so its first slot is 1 and the flow need not be read again.
    Without a reading for slot 1 the vector is unknown (``missing="null"``) or comes from the
    day's next slot that has one (``"next"``).
    """
    if missing not in ("null", "next"):
        raise ValueError("missing must be 'null' or 'next'")
    last = 1 if missing == "null" else spec.slots
    first = earliest_reading(scale_weather(weather).filter(F.col("slot").between(1, last)))
    onehot = weather_onehot(F.col("weather_code"))
    return first.select(
        "date", others_vector(F.col("temperature"), F.col("windspeed"), onehot).alias("others")
    )


def raw_days(
    flow: DataFrame,
    weather: DataFrame,
    spec: GridSpec,
    *,
    missing: str = "null",
    unique: bool = False,
) -> DataFrame:
    """(date, flow, others, label) for every complete day.

    ``unique=True`` vouches that (date, slot, cell) identifies flow rows, as it does right after
    an aggregation, and saves the merging shuffle.
    """
    tensors = day_tensor(scale_flow(flow), spec, unique=unique)
    return (
        tensors.join(day_others(weather, spec, missing), "date", "left")
        .select("date", "flow", "others", weekend_label(F.col("date")).alias("label"))
    )


def write_day_sets(days: DataFrame, raw_path: str, gen_path: str, seed: int = 0) -> None:
    """Write the raw set, then augment from what was written, not from the flow again."""
    write_raw_days(days, raw_path)
    stored = days.sparkSession.read.schema(days.schema).parquet(raw_path)
    write_gen_days(augment_days(stored, seed), gen_path)
