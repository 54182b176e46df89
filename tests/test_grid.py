"""Tensors, stencils and pooling against NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowmosaic.operators import grid
from flowmosaic.operators.quality import cell_quality
from flowmosaic.plans.days import day_totals
from flowmosaic.schema import GridSpec

SPEC = GridSpec(6, 5, 720)


@pytest.fixture
def cube(flow_rows):
    rng = np.random.default_rng(1)
    values = np.round(rng.normal(size=(2, SPEC.slots, 2, SPEC.rows, SPEC.cols)) * 100, 2)
    present = rng.random((2, SPEC.slots, SPEC.rows, SPEC.cols)) < 0.6
    rows = [
        (f"2024010{d + 1}", s + 1, r, c, float(values[d, s, 0, r, c]), float(values[d, s, 1, r, c]))
        for d, s, r, c in zip(*np.nonzero(present))
    ]
    return flow_rows([(a, int(b), int(c), int(d), e, f) for a, b, c, d, e, f in rows]), values * present[:, :, None]


def dense(frame, value, shape):
    out = np.zeros(shape)
    for r in frame.collect():
        out[r["date"].day - 1, r["slot"] - 1, r["grid_row"], r["grid_col"]] = r[value]
    return out


def test_day_tensor_layout_and_zero_fill(cube):
    flow, values = cube
    got = {r["date"].day: np.array(r["flow"]) for r in grid.day_tensor(flow, SPEC).collect()}
    for d in (0, 1):
        # [row][col][2 * slot + channel]
        want = values[d].transpose(2, 3, 0, 1).reshape(-1)
        assert np.array_equal(got[d + 1], want)


def test_day_tensor_merges_copies_and_ignores_cells_off_the_grid(flow_rows):
    spec = GridSpec(1, 2, 720)
    rows = [("20240101", 1, 0, 0, 1.0, 2.0), ("20240101", 2, 0, 1, 3.0, 4.0)]
    noisy = rows + [rows[0], ("20240101", 1, 0, 2, 9.0, 9.0), ("20240101", 1, 5, 0, 9.0, 9.0)]
    got = grid.day_tensor(flow_rows(noisy), spec).first()["flow"]
    assert got == [1.0, 2.0, 0.0, 0.0, 0.0, 0.0, 3.0, 4.0]


def test_copies_and_strays_follow_one_rule(flow_rows):
    """Tensor, totals, stencil, pooling and zero-fill see the smallest copy and no cell off the grid."""
    spec = GridSpec(1, 2, 720)
    good = [("20240101", 1, 0, 0, 1.0, 7.0), ("20240101", 2, 0, 1, 3.0, 4.0)]
    strays = [("20240101", 1, 0, 2, 9.0, 9.0), ("20240101", 1, -1, 0, 9.0, 9.0), ("20240101", 1, None, 0, 9.0, 9.0)]
    flow = flow_rows(good + [("20240101", 1, 0, 0, 50.0, 2.0)] + strays)
    assert grid.day_tensor(flow, spec).first()["flow"] == [1.0, 7.0, 0.0, 0.0, 0.0, 0.0, 3.0, 4.0]
    total = day_totals(flow, spec).first()
    assert (total["inflow"], total["outflow"], total["n_cells"]) == (4.0, 11.0, 2)
    ones = [[1.0] * 3 for _ in range(3)]
    stencil = {(r["slot"], r["grid_row"], r["grid_col"]): r["v"] for r in grid.grid_stencil(flow, spec, ones, "outflow", "v").collect()}
    assert stencil == {(1, 0, 0): 7.0, (1, 0, 1): 7.0, (2, 0, 0): 4.0, (2, 0, 1): 4.0}
    pooled = {(r["slot"], r["grid_row"], r["grid_col"], r["inflow"]) for r in grid.grid_pool(flow, spec, 2, ["inflow"]).collect()}
    assert pooled == {(1, 0, 0, 1.0), (2, 0, 0, 3.0)}
    assert sorted(r["inflow"] for r in grid.zero_fill(flow, spec).collect()) == [0.0, 0.0, 1.0, 3.0]
    report = cell_quality(flow, spec).first()
    assert (report["n_cells"], report["n_copies"], report["n_stray"]) == (2, 1, 3)


def test_a_false_vouching_for_unique_cells_is_an_error(flow_rows):
    spec = GridSpec(1, 1, 720)
    rows = [("20240101", s, 0, 0, 1.0, 1.0) for s in (1, 2, 2)]
    with pytest.raises(Exception, match="more than once"):
        grid.day_tensor(flow_rows(rows), spec, unique=True).collect()


def test_day_with_all_cells_off_the_grid_is_all_zero(flow_rows):
    spec = GridSpec(1, 1, 720)
    rows = [("20240101", s, 3, 3, 1.0, 1.0) for s in (1, 2)]
    assert grid.day_tensor(flow_rows(rows), spec).first()["flow"] == [0.0] * 4


def test_full_size_day(spark):
    spec = GridSpec()
    cells = spark.range(spec.cells * spec.slots).select(
        F.lit("2016-03-01").cast("date").alias("date"),
        (F.col("id") % 48 + 1).cast("int").alias("slot"),
        F.floor(F.col("id") / 48 / 32).cast("int").alias("grid_row"),
        (F.floor(F.col("id") / 48) % 32).cast("int").alias("grid_col"),
        F.col("id").cast("double").alias("inflow"),
        (-F.col("id")).cast("double").alias("outflow"),
    )
    flow = np.array(grid.day_tensor(cells, spec).first()["flow"])
    assert len(flow) == 98_304
    assert np.array_equal(flow[0::2], np.arange(49_152)) and np.array_equal(flow[1::2], -np.arange(49_152.0))


def test_delta_kernel_is_identity(cube):
    flow, values = cube
    delta = [[1.0 if (a, b) == (2, 2) else 0.0 for b in range(5)] for a in range(5)]
    out = grid.grid_stencil(flow, SPEC, delta, "inflow", "v")
    assert np.allclose(dense(out, "v", values[:, :, 0].shape), values[:, :, 0])


@pytest.mark.parametrize("side", [1, 3, 5])
def test_stencil_equals_cross_correlation(cube, side):
    flow, values = cube
    kernel = np.random.default_rng(2).normal(size=(side, side))
    got = dense(grid.grid_stencil(flow, SPEC, kernel.tolist(), "outflow", "v"), "v", values[:, :, 1].shape)
    h = side // 2
    padded = np.pad(values[:, :, 1], ((0, 0), (0, 0), (h, h), (h, h)))
    want = sum(
        kernel[a, b] * padded[:, :, a : a + SPEC.rows, b : b + SPEC.cols] for a in range(side) for b in range(side)
    )
    assert np.allclose(got, want)


def test_stencil_fans_out_after_its_only_shuffle(cube):
    flow, _ = cube
    out = grid.grid_stencil(flow, SPEC, [[1.0]], "inflow", "v", unique=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("size", [2, 4])
def test_pooling_with_zero_fill(cube, size):
    flow, values = cube
    filled = grid.net_flow(grid.zero_fill(flow, SPEC))
    assert filled.count() == 2 * SPEC.slots * SPEC.cells
    net = values[:, :, 0] - values[:, :, 1]
    pooled = grid.grid_pool(filled, SPEC, size, ["net"], unique=True).collect()
    for r in pooled:
        block = net[
            r["date"].day - 1, r["slot"] - 1,
            r["grid_row"] * size : (r["grid_row"] + 1) * size, r["grid_col"] * size : (r["grid_col"] + 1) * size,
        ]
        assert np.isclose(r["net"], block.max())
    assert len(pooled) == 2 * SPEC.slots * -(-SPEC.rows // size) * -(-SPEC.cols // size)


def test_scaling(spark, flow_rows):
    got = grid.scale_flow(flow_rows([("20240101", 1, 0, 0, 250.0, 10.0)])).first()
    assert (got["inflow"], got["outflow"]) == (2.5, 0.1)
    weather = spark.createDataFrame([(35.0, 12.0)], "temperature DOUBLE, windspeed DOUBLE")
    assert tuple(grid.scale_weather(weather).first()) == (3.5, 1.2)


def test_cell_series(flow_rows):
    spec = GridSpec(1, 1, 360)
    rows = [("20240101", 4, 0, 0, 4.0, 0.0), ("20240101", 2, 0, 0, 2.0, 0.0)]
    got = grid.cell_series(flow_rows(rows), spec, "inflow", "series").first()["series"]
    assert got == [0.0, 2.0, 0.0, 4.0]


@pytest.mark.parametrize("size", [2, 4])
def test_array_pooling_and_net_of_a_day(cube, size):
    from flowmosaic.functions.arrays import net_tensor, pool_tensor

    flow, values = cube
    days = grid.day_tensor(flow, SPEC)
    rows = days.select("date", pool_tensor(F.col("flow"), SPEC, size).alias("p"), net_tensor(F.col("flow")).alias("n")).collect()
    for row in rows:
        day = values[row["date"].day - 1]  # slot, channel, row, col
        want = [
            day[s, ch, r * size : (r + 1) * size, c * size : (c + 1) * size].max()
            for r in range(-(-SPEC.rows // size)) for c in range(-(-SPEC.cols // size))
            for s in range(SPEC.slots) for ch in (0, 1)
        ]
        assert np.allclose(row["p"], want)
        assert np.allclose(row["n"], (day[:, 0] - day[:, 1]).transpose(1, 2, 0).reshape(-1))
