"""Grid operators: unit scaling, day tensors, stencils and pooling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmosaic.functions.arrays import bind, flat_position
from flowmosaic.operators.quality import (
    CELL_KEYS,
    clean_cells,
    deduplicate_cells,
    gate_aggregates,
    gate_passed,
    on_grid,
)
from flowmosaic.schema import FLOW_UNIT, METEO_UNIT, GridSpec


def scale_flow(flow: DataFrame) -> DataFrame:
    return flow.withColumns(
        {"inflow": F.col("inflow") / FLOW_UNIT, "outflow": F.col("outflow") / FLOW_UNIT}
    )


def scale_weather(weather: DataFrame) -> DataFrame:
    return weather.withColumns(
        {
            "temperature": F.col("temperature") / METEO_UNIT,
            "windspeed": F.col("windspeed") / METEO_UNIT,
        }
    )


def net_flow(flow: DataFrame) -> DataFrame:
    """Adds inflow - outflow; derived on demand, never stored."""
    return flow.withColumn("net", F.col("inflow") - F.col("outflow"))


def fill_positions(entries: Column, size: int, width: int) -> Column:
    """Sorted array of (pos, v1..v_width) structs -> dense array of ``size`` values.

    Each struct covers positions pos .. pos+width-1; the gaps between structs become zeros. One
    linear pass with built-in array functions, and a shorter one where there are no gaps.
    """
    def own(item: Column) -> Column:
        return F.array(*[item[f"v{k}"] for k in range(1, width + 1)])

    def dense(items: Column) -> Column:
        starts = F.concat(F.array(F.lit(-width)), F.transform(items, lambda e: e["pos"]))
        parts = F.zip_with(
            items,
            F.slice(starts, F.lit(1), F.size(items)),
            lambda item, before: F.concat(
                F.array_repeat(F.lit(0.0), (item["pos"] - before - width).cast("int")), own(item)
            ),
        )
        last = F.element_at(starts, -1)
        with_gaps = F.concat(
            F.flatten(parts), F.array_repeat(F.lit(0.0), (size - last - width).cast("int"))
        )
        no_gaps = F.size(items) * width == size
        return F.when(no_gaps, F.flatten(F.transform(items, own))).otherwise(with_gaps)

    return bind(entries, dense)


def collect_dense(
    rows: DataFrame,
    keys: Sequence[str],
    position: Column,
    values: Sequence[Column],
    size: int,
    out: str,
    extra: Sequence[Column] = (),
    where: Column | None = None,
) -> DataFrame:
    """Group long rows by ``keys`` into one zero-filled array of ``size`` values per group.

    Positions must be unique within a group, which bounds a group by ``size``; a repeated one is an
    error, for it would shift all that follow. Rows outside ``where`` count for ``extra`` aggregates
    but not for the array.
    """
    entry = F.struct(
        position.alias("pos"), *[v.alias(f"v{k}") for k, v in enumerate(values, start=1)]
    )
    if where is not None:
        entry = F.when(where, entry)
    grouped = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("_entries"), *extra)
    positions = F.transform("_entries", lambda e: e["pos"])
    filled = F.when(
        F.size(F.array_distinct(positions)) == F.size("_entries"),
        fill_positions(F.col("_entries"), size, len(values)),
    ).otherwise(F.raise_error(F.lit("a cell occurs more than once; merge copies with clean_cells")))
    return grouped.withColumn(out, filled).drop("_entries")


def day_tensor(
    flow: DataFrame, spec: GridSpec, *, unique: bool = False, complete_only: bool = True
) -> DataFrame:
    """(date, flow): a day's slots and cells as one array, missing cells 0.

    Gate and tensor come out of the same aggregation: one read of the flow, one shuffle by date.
    Copies of a cell are merged first with map-side combining unless the caller vouches that keys
    are unique, so a group never exceeds one day's tensor.
    """
    cells = flow if unique else deduplicate_cells(flow)
    # Strays stay out of the array, but their slots count for the gate as in ``complete_days``.
    inside = on_grid(spec) & F.col("slot").between(1, spec.slots)
    position = flat_position(
        F.col("grid_row"), F.col("grid_col"), (F.col("slot") - 1) * 2, spec
    )
    days = collect_dense(
        cells,
        ["date"],
        position,
        [F.col("inflow"), F.col("outflow")],
        spec.tensor_size,
        "flow",
        gate_aggregates(spec.slots) if complete_only else (),
        inside,
    )
    if complete_only:
        days = days.filter(gate_passed(spec.slots))
    return days.select("date", "flow")


def cell_series(flow: DataFrame, spec: GridSpec, value: str, out: str) -> DataFrame:
    """(date, grid_row, grid_col, out): one value per slot of the day, missing slots 0."""
    return collect_dense(
        flow,
        ["date", "grid_row", "grid_col"],
        F.col("slot") - 1,
        [F.col(value)],
        spec.slots,
        out,
    )


def zero_fill(flow: DataFrame, spec: GridSpec, *, unique: bool = False) -> DataFrame:
    """Every cell of every (date, slot) that has at least one row; absent cells become 0.

    Zero rows are generated from the distinct slots and merged by one aggregation, after
    ``clean_cells``.
    """
    grid = F.sequence(F.lit(0), F.lit(spec.cells - 1))
    zeros = (
        flow.select("date", "slot")
        .distinct()
        .withColumn("_cell", F.explode(grid))
        .select(
            "date",
            "slot",
            F.floor(F.col("_cell") / spec.cols).cast("int").alias("grid_row"),
            (F.col("_cell") % spec.cols).cast("int").alias("grid_col"),
            F.lit(0.0).alias("inflow"),
            F.lit(0.0).alias("outflow"),
        )
    )
    return (
        clean_cells(flow, spec, unique=unique)
        .select(*CELL_KEYS, "inflow", "outflow")
        .unionByName(zeros)
        .groupBy(*CELL_KEYS)
        .agg(F.sum("inflow").alias("inflow"), F.sum("outflow").alias("outflow"))
    )


def grid_stencil(
    flow: DataFrame,
    spec: GridSpec,
    kernel: Sequence[Sequence[float]],
    value: str,
    out: str,
    *,
    unique: bool = False,
) -> DataFrame:
    """Cross-correlation with an odd-sided kernel, stride 1, zero padding, after ``clean_cells``.

    Cell (r, c) feeds target (r - a + h, c - b + h) with weight kernel[a][b]. Cells are co-located
    by (date, slot) before they fan out, so the shuffle carries one row per cell and the fan-out
    is summed where it is made. Targets that no cell reaches have no row.
    """
    half_rows, half_cols = len(kernel) // 2, len(kernel[0]) // 2
    taps = F.array(
        *[
            F.struct(
                F.lit(half_rows - a).alias("dr"),
                F.lit(half_cols - b).alias("dc"),
                F.lit(float(w)).alias("w"),
            )
            for a, line in enumerate(kernel)
            for b, w in enumerate(line)
        ]
    )
    return (
        clean_cells(flow, spec, unique=unique)
        .select(*CELL_KEYS, value)
        .repartition("date", "slot")
        .select("date", "slot", "grid_row", "grid_col", value, F.explode(taps).alias("tap"))
        .select(
            "date",
            "slot",
            (F.col("grid_row") + F.col("tap.dr")).alias("grid_row"),
            (F.col("grid_col") + F.col("tap.dc")).alias("grid_col"),
            (F.col(value) * F.col("tap.w")).alias("_part"),
        )
        .filter(
            F.col("grid_row").between(0, spec.rows - 1)
            & F.col("grid_col").between(0, spec.cols - 1)
        )
        .groupBy(*CELL_KEYS)
        .agg(F.sum("_part").alias(out))
    )


def grid_pool(
    flow: DataFrame, spec: GridSpec, size: int, values: Sequence[str], *, unique: bool = False
) -> DataFrame:
    """Max over size x size blocks, stride ``size``, after ``clean_cells``; absent cells are skipped.

    Zero-fill first where values can be negative.
    """
    return clean_cells(flow, spec, unique=unique).groupBy(
        "date",
        "slot",
        F.floor(F.col("grid_row") / size).cast("int").alias("grid_row"),
        F.floor(F.col("grid_col") / size).cast("int").alias("grid_col"),
    ).agg(*[F.max(v).alias(v) for v in values])
