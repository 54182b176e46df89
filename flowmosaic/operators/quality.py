"""Which days have a full set of time slots, and in what order the slots come."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmosaic.schema import GridSpec

CELL_KEYS = ("date", "slot", "grid_row", "grid_col")
WORD_BITS = 62 # bits used per BIGINT; a half-hour day (48 slots) needs one word


def _bitmap_words(slots: int) -> list[tuple[int, int]]:
    """(first slot, number of slots) of every bitmap word."""
    return [(low + 1, min(WORD_BITS, slots - low)) for low in range(0, slots, WORD_BITS)]


def _slot_bits(first: int, size: int) -> Column:
    offset = F.col("slot") - first
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), offset)
    return F.when(offset.between(0, size - 1), bit).otherwise(F.lit(0).cast("bigint"))


def gate_aggregates(slots: int = 48) -> list[Column]:
    """Per-day aggregates of the gate: slot bitmap words and rows whose slot is out of range.

    ``bit_or`` combines on the map side, so each task ships one row per date however hot the date
    is; no distinct shuffle.
    """
    in_range = F.coalesce(F.col("slot").between(1, slots), F.lit(False))
    bitmaps = [
        F.bit_or(_slot_bits(first, size)).alias(f"bits{k}")
        for k, (first, size) in enumerate(_bitmap_words(slots))
    ]
    return [*bitmaps, F.sum(F.when(in_range, 0).otherwise(1)).alias("bad_rows")]


def slots_present(slots: int = 48) -> Column:
    """Number of distinct slots, from the bitmap words."""
    counts = [F.bit_count(F.col(f"bits{k}")) for k in range(len(_bitmap_words(slots)))]
    return reduce(lambda a, b: a + b, counts).cast("int")


def gate_passed(slots: int = 48) -> Column:
    """Every slot present and no row outside the range."""
    return (slots_present(slots) == slots) & (F.col("bad_rows") == 0)


def slot_bitmap(flow: DataFrame, slots: int = 48) -> DataFrame:
    """Per date: bitmap of the slots present, how many, and rows whose slot is out of range."""
    return (
        flow.groupBy("date").agg(*gate_aggregates(slots)).withColumn("n_slots", slots_present(slots))
    )


def day_quality(flow: DataFrame, slots: int = 48) -> DataFrame:
    """(date, n_slots, bad_rows, is_complete)."""
    return slot_bitmap(flow, slots).select(
        "date", "n_slots", "bad_rows", gate_passed(slots).cast("int").alias("is_complete")
    )


def complete_days(flow: DataFrame, slots: int = 48) -> DataFrame:
    return slot_bitmap(flow, slots).filter(gate_passed(slots)).select("date")


def complete_day_rows(
    flow: DataFrame, slots: int = 48, observed: DataFrame | None = None
) -> DataFrame:
    """Rows of complete days.

    The day list has one row per date, so the planner broadcasts it when its measured size allows
    and shuffles otherwise; reading it touches only the date and slot columns. Where ``flow`` is
    itself computed, ``observed`` can name cheaper input with the same (date, slot) pairs.
    """
    days = complete_days(flow if observed is None else observed, slots)
    return flow.join(days, "date", "left_semi")


def incomplete_day_rows(
    flow: DataFrame, slots: int = 48, observed: DataFrame | None = None
) -> DataFrame:
    days = complete_days(flow if observed is None else observed, slots)
    return flow.join(days, "date", "left_anti")


def duplicate_cells(flow: DataFrame) -> DataFrame:
    """Report of (date, slot, cell) keys that occur more than once."""
    return (
        flow.groupBy("date", "slot", "grid_row", "grid_col")
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def deduplicate_cells(flow: DataFrame) -> DataFrame:
    """One row per (date, slot, cell): the smallest of the copies by (inflow, outflow), then by the other values."""
    first = [c for c in ("inflow", "outflow") if c in flow.columns]
    values = first + [c for c in flow.columns if c not in (*CELL_KEYS, *first)]
    return (
        flow.groupBy(*CELL_KEYS)
        .agg(F.min(F.struct(*values)).alias("_kept"))
        .select(*CELL_KEYS, *[F.col("_kept")[v].alias(v) for v in values])
    )


def on_grid(spec: GridSpec) -> Column:
    """The cell lies on the grid. Null coordinates do not."""
    inside = F.col("grid_row").between(0, spec.rows - 1) & F.col("grid_col").between(0, spec.cols - 1)
    return F.coalesce(inside, F.lit(False))


def clean_cells(flow: DataFrame, spec: GridSpec, *, unique: bool = False) -> DataFrame:
    """The cells that tensors, totals, stencils, pooling and zero-filling work on.

    One rule for all: cells off the grid are left out, and of several copies of a cell
    ``deduplicate_cells`` chooses. ``cell_quality`` counts both. ``unique=True`` vouches that there
    are no copies, as after an aggregation, and saves the merging shuffle.
    """
    inside = flow.filter(on_grid(spec))
    return inside if unique else deduplicate_cells(inside)


def cell_quality(flow: DataFrame, spec: GridSpec) -> DataFrame:
    """(date, n_cells, n_copies, n_stray): distinct cells on the grid, surplus copies, rows off the grid."""
    per_cell = flow.groupBy(*CELL_KEYS).agg(
        F.count(F.lit(1)).alias("_rows"), F.first(on_grid(spec)).alias("_inside")
    )
    inside = F.col("_inside")
    return per_cell.groupBy("date").agg(
        F.count(F.when(inside, 1)).alias("n_cells"),
        F.sum(F.when(inside, F.col("_rows") - 1).otherwise(0)).alias("n_copies"),
        F.sum(F.when(inside, 0).otherwise(F.col("_rows"))).alias("n_stray"),
    )


def slot_sequence(flow: DataFrame) -> DataFrame:
    """Position of each distinct slot within its day (at most one day's slots per window)."""
    by_slot = Window.partitionBy("date").orderBy("slot")
    return (
        flow.select("date", "slot")
        .distinct()
        .withColumn("position", F.row_number().over(by_slot))
        .withColumn("next_slot", F.coalesce(F.lead("slot").over(by_slot), F.lit(-1)))
    )
