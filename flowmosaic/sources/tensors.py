"""Flow cubes as dense `.npy` files: a data source with range reads and all-or-nothing writes.

A folder holds pairs of files: ``X.npy``, doubles of shape (slots, values), and ``X.keys.npy``, the slot
keys as bytes. Paths go through Arrow's file systems, so shared stores work like local folders.
"""

from __future__ import annotations

import io
import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from flowmosaic.schema import GridSpec

SLOT_SCHEMA = "slot_key STRING, cube ARRAY<DOUBLE>"
#: Slots of one file and of one read task at most (a slot of the full grid is 16 kB).
SLOTS_PER_FILE = 2048
SLOTS_PER_TASK = 1024
#: Slots handed to Spark at a time.
SLOTS_PER_BATCH = 64
PENDING = "_pending"


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path in it; a bare path is local."""
    if path.startswith("file:"):
        path = re.sub("^file:/*", "/", path)
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def array_shape(file: pa.NativeFile) -> tuple[tuple[int, ...], np.dtype, int]:
    """Shape, type and first data byte of an open `.npy` file in row-major order."""
    version = np.lib.format.read_magic(file)
    read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
    shape, by_column, kind = read(file)
    if by_column:
        raise ValueError("arrays must be stored row by row")
    return shape, kind, file.tell()


def read_rows(store: pafs.FileSystem, path: str, start: int, stop: int) -> np.ndarray:
    """Rows ``start`` to ``stop`` of a file; no other data byte is read."""
    with store.open_input_file(path) as file:
        shape, kind, first = array_shape(file)
        width = kind.itemsize * int(np.prod(shape[1:], dtype=np.int64))
        file.seek(first + start * width)
        return np.frombuffer(file.read((stop - start) * width), kind).reshape(stop - start, *shape[1:])


def array_bytes(values: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, values, allow_pickle=False)
    return out.getvalue()


@dataclass
class SlotRange(InputPartition):
    path: str
    start: int
    stop: int


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class TensorReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[SlotRange]:
        store, base = open_store(self.path)
        out = []
        for entry in sorted(store.get_file_info(pafs.FileSelector(base)), key=lambda e: e.path):
            if not entry.path.endswith(".npy") or entry.path.endswith(".keys.npy"):
                continue
            with store.open_input_file(entry.path) as file:
                n = array_shape(file)[0][0]
            out += [SlotRange(entry.path, at, min(n, at + SLOTS_PER_TASK)) for at in range(0, n, SLOTS_PER_TASK)]
        return out or [SlotRange("", 0, 0)]

    def read(self, partition: SlotRange) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(self.path)
        for start in range(partition.start, partition.stop, SLOTS_PER_BATCH):
            stop = min(partition.stop, start + SLOTS_PER_BATCH)
            cubes = read_rows(store, partition.path, start, stop).reshape(stop - start, -1)
            keys = read_rows(store, partition.path.removesuffix(".npy") + ".keys.npy", start, stop)
            offsets = pa.array(np.arange(len(cubes) + 1) * cubes.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(cubes.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([k.decode() for k in keys]), lists], names=["slot_key", "cube"])


class TensorWriter(DataSourceArrowWriter):
    """Tasks write under a pending folder; the driver moves all files into place, or none.

    The driver makes the folder, so a task still running after the run was given up cannot bring it back.
    """

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.run = path, overwrite, uuid.uuid4().hex
        open_store(path)[0].create_dir(self.pending)

    @property
    def pending(self) -> str:
        return posixpath.join(open_store(self.path)[1], PENDING, self.run)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, _ = open_store(self.path)
        names: list[str] = []
        keys: list[str] = []
        cubes: list[np.ndarray] = []

        def flush() -> None:
            if keys:
                name = f"part-{uuid.uuid4().hex}"
                for suffix, values in ((".npy", np.stack(cubes)), (".keys.npy", np.array(keys, "S"))):
                    with store.open_output_stream(posixpath.join(self.pending, name + suffix)) as out:
                        out.write(array_bytes(values))
                    names.append(name + suffix)
            keys.clear()
            cubes.clear()

        for batch in iterator:
            lists = batch.column(1)
            for i, key in enumerate(batch.column(0).to_pylist()):
                keys.append(key)
                cubes.append(lists[i].values.to_numpy(zero_copy_only=False))
                if len(keys) >= SLOTS_PER_FILE:
                    flush()
        flush()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        store, base = open_store(self.path)
        before = [e.path for e in store.get_file_info(pafs.FileSelector(base, allow_not_found=True)) if e.path.endswith(".npy")]
        for message in messages:
            for name in message.names if message else ():
                store.move(posixpath.join(self.pending, name), posixpath.join(base, name))
        for path in before if self.overwrite else ():
            store.delete_file(path)
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        """Drop this run's pending folder, and the folder of all runs once it is empty."""
        store, base = open_store(self.path)
        if store.get_file_info(self.pending).type != pafs.FileType.NotFound:
            store.delete_dir(self.pending)
        above = posixpath.join(base, PENDING)
        if store.get_file_info(above).type != pafs.FileType.NotFound and not store.get_file_info(pafs.FileSelector(above)):
            store.delete_dir(above)


class TensorFiles(DataSource):
    """``format("tensor_files")``; register once per session with :func:`register`."""

    @classmethod
    def name(cls) -> str:
        return "tensor_files"

    def schema(self) -> str:
        return SLOT_SCHEMA

    def reader(self, schema) -> TensorReader:
        return TensorReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> TensorWriter:
        return TensorWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TensorFiles)


def write_tensor_files(flow: DataFrame, path: str, spec: GridSpec, mode: str = "overwrite") -> None:
    """Long flow as one dense cube per slot: all inflows by cell, then all outflows; NaN where there is no cell.

    Cells off the grid are left out; a cell that comes twice raises.
    """
    register(flow.sparkSession)
    at = (F.col("grid_row") * spec.cols + F.col("grid_col")).cast("int")
    on_grid = F.col("grid_row").between(0, spec.rows - 1) & F.col("grid_col").between(0, spec.cols - 1)
    slots = flow.filter(on_grid).groupBy("date", "slot").agg(
        *[F.map_from_entries(F.collect_list(F.struct(at, F.col(c)))).alias(c) for c in ("inflow", "outflow")]
    )
    cells = F.sequence(F.lit(0), F.lit(spec.cells - 1))
    dense = lambda c: F.transform(cells, lambda i: F.coalesce(F.try_element_at(F.col(c), i), F.lit(float("nan"))))
    key = F.concat(F.date_format("date", "yyyyMMdd"), F.lpad(F.col("slot").cast("string"), 2, "0"))
    cubes = slots.select(key.alias("slot_key"), F.concat(dense("inflow"), dense("outflow")).alias("cube"))
    cubes.write.format("tensor_files").mode(mode).option("path", path).save()


def scan_tensor_files(spark: SparkSession, path: str, spec: GridSpec) -> DataFrame:
    """Long flow again: (date, slot, grid_row, grid_col, inflow, outflow) of the cells that are there."""
    register(spark)
    cubes = spark.read.format("tensor_files").option("path", path).load()
    cell = F.explode(F.sequence(F.lit(0), F.lit(spec.cells - 1)))
    value = lambda offset: F.nanvl(F.element_at("cube", F.col("_cell") + 1 + offset), F.lit(None).cast("double"))
    return (
        cubes.select("slot_key", "cube", cell.alias("_cell"))
        .select(
            F.to_date(F.substring("slot_key", 1, 8), "yyyyMMdd").alias("date"), F.substring("slot_key", 9, 2).cast("int").alias("slot"),
            F.floor(F.col("_cell") / spec.cols).cast("int").alias("grid_row"), (F.col("_cell") % spec.cols).cast("int").alias("grid_col"),
            value(0).alias("inflow"), value(spec.cells).alias("outflow"),
        )
        .filter("inflow IS NOT NULL OR outflow IS NOT NULL")
    )
