"""Rasters as tables.

``read`` goes through Spark's own file reader, so it works in any store that
Spark reads.  ``strips`` and the data source ``geotiff`` (a partition for a
strip of a file, or for many strips if they are small) open files themselves and
read byte ranges: the directory, and the strips asked for.  All decode only the strips and bands asked for; the driver
lists files and opens none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions.columns import normalize, spectral_indices
from . import tiff

PIXEL_ROWS = "path string, band int, description string, y int, x int, value double"
META = "path string, columns int, rows int, bands int, dtype string, x0 double, dx double, rx double, y0 double, ry double, dy double, crs string, descriptions array<string>"


def strip_bounds(rows: int, parts: int) -> list[tuple[int, int]]:
    """First and last row (not included) of each strip; the last strip takes the rows left over."""
    step = max(1, rows // parts)
    parts = min(parts, rows)
    return [(k * step, rows if k == parts - 1 else (k + 1) * step) for k in range(parts)]


def pixel_batches(path: str, data: bytes | Callable[[int, int], bytes], bands: list[int] | None, first: int, last: int, r: tiff.Raster) -> Iterator[pa.RecordBatch]:
    """Pixel rows, some rows of the raster at a time."""
    step = max(1, 1_000_000 // max(1, r.columns * r.bands))
    for a in range(first, last, step):
        b = min(last, a + step)
        array = tiff.read_rows(data, r, a, b, bands)
        wanted = list(range(r.bands)) if bands is None else bands
        n = (b - a) * r.columns
        yield pa.RecordBatch.from_pydict({
            "path": pa.array([path] * (n * len(wanted))), "band": pa.array(np.repeat(np.array(wanted, np.int32) + 1, n)), "description": pa.array(np.repeat(np.array([r.descriptions[k] for k in wanted], object), n), pa.string()),
            "y": pa.array(np.tile(np.repeat(np.arange(a, b, dtype=np.int32), r.columns), len(wanted))), "x": pa.array(np.tile(np.arange(r.columns, dtype=np.int32), (b - a) * len(wanted))), "value": pa.array(array.reshape(-1).astype(np.float64)),
        })


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").option("recursiveFileLookup", "true").load(path)


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """A row for each raster: size, sample type, place, coordinate system, band descriptions. Reads the directories only."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for name in batch.column(0).to_pylist():
                with ranges(name) as read:
                    found.append(tiff.header(read))
            geo = np.array([r.geo for r in found], float).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), *(pa.array([getattr(r, c) for r in found], pa.int32()) for c in ("columns", "rows", "bands")), pa.array([r.dtype for r in found], pa.string()),
                *(pa.array(geo[:, k]) for k in range(6)), pa.array([r.crs for r in found], pa.string()), pa.array([r.descriptions for r in found], pa.list_(pa.string())),
            ], names=[c.split()[0] for c in META.split(", ")])

    return _files(spark, path).select("path").mapInArrow(scan, META)


def read(spark: SparkSession, path: str, descriptions: list[str] | None = None) -> DataFrame:
    """Pixel rows of all rasters under path; with descriptions only the bands so named (exactly)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = data.as_buffer().to_pybytes()
                r = tiff.header(data)
                bands = None if descriptions is None else [k for k, d in enumerate(r.descriptions) if d in descriptions]
                if bands is None or bands:
                    yield from pixel_batches(name, data, bands, 0, r.rows, r)

    return _files(spark, path).select("path", "content").mapInArrow(scan, PIXEL_ROWS)


def read_normalized(spark: SparkSession, path: str, descriptions: list[str], scale: float = 10000.0, parts: int = 1, indices: tuple[str, ...] = ()) -> DataFrame:
    """path, strip, y, x and a column for each described band, scaled and clipped to [0, 1]; a band that a raster lacks is 0."""
    wide = strips(spark, path, descriptions, parts)
    wide = wide.select("path", "strip", "y", "x", *(F.coalesce(normalize(F.col(d), scale), F.lit(0.0)).alias(d) for d in descriptions))
    return wide.withColumns(spectral_indices(indices)) if indices else wide


def strips(spark: SparkSession, path: str, descriptions: list[str], parts: int = 1) -> DataFrame:
    """path, strip, y, x and a column for each described band (NULL: the raster lacks it): a task for a strip, which reads the bytes of its rows, without a shuffle of pixels."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with ranges(name) as read:
                    r = tiff.header(read)
                    bounds = strip_bounds(r.rows, parts)
                    if k >= len(bounds):
                        continue
                    has = [d for d in descriptions if d in r.descriptions]
                    step = max(1, 1_000_000 // max(1, r.columns * max(1, len(has))))
                    for a in range(*bounds[k], step):
                        b = min(bounds[k][1], a + step)
                        values = dict(zip(has, tiff.read_rows(read, r, a, b, [r.descriptions.index(d) for d in has]))) if has else {}
                        n = (b - a) * r.columns
                        y, x = np.divmod(np.arange(n, dtype=np.int32), np.int32(r.columns))
                        columns = [pa.array(values[d].reshape(-1).astype(np.float64)) if d in values else pa.nulls(n, pa.float64()) for d in descriptions]
                        yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(np.full(n, k, np.int32)), pa.array(y + np.int32(a)), pa.array(x), *columns], names=["path", "strip", "y", "x", *descriptions])

    each = _files(spark, path).select("path", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("strip"))
    schema = StructType.fromDDL("path string, strip int, y int, x int")
    for d in descriptions:
        schema = schema.add(d, "double")
    return each.repartition("path", "strip").mapInArrow(scan, schema)


class Strips(InputPartition):
    """Runs of strips: a file, the first strip and the last (not included)."""

    def __init__(self, runs: list[tuple[str, int, int]]):
        self.runs = runs


#: Bytes of the strips of a partition, what it takes to open a file in such bytes, and the number of partitions up to which each strip has its own.
PACK_BYTES, OPEN_BYTES, PACKS = 16 << 20, 16 << 10, 64


def packed(files: list[tuple[str, int]], strips: int) -> list[list[tuple[str, int, int]]]:
    """All strips of files (path, bytes) in their order, as runs of bounded bytes; a strip is not cut."""
    most = min(PACK_BYTES, sum(n + OPEN_BYTES for _, n in files) / PACKS)
    out: list[list[tuple[str, int, int]]] = []
    room = 0.0
    for path, n in files:
        each = (n + OPEN_BYTES) / strips
        k = 0
        while k < strips:
            if room < each:
                out.append([])
                room = max(most, each)
            taken = min(strips - k, int(room / each))
            out[-1].append((path, k, k + taken))
            room -= taken * each
            k += taken
    return out


def whole(batches: Iterator[pa.RecordBatch], least: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """The rows of small batches in batches of some size."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= least:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@contextmanager
def ranges(path: str) -> Iterator[Callable[[int, int], bytes]]:
    """read(place, length) of an open file."""
    where, name = _open(path)
    with where.open_input_file(name) as f:

        def read(at: int, n: int) -> bytes:
            f.seek(at)
            return f.read(n)

        yield read


class GeoTiffSource(DataSource):
    """spark.read.format("geotiff").option("strips", 18).load(path), df.write.format("geotiff").save(path)."""

    @classmethod
    def name(cls) -> str:
        return "geotiff"

    def schema(self) -> str:
        return PIXEL_ROWS

    def reader(self, schema: StructType) -> "GeoTiffReader":
        return GeoTiffReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> "GeoTiffWriter":
        return GeoTiffWriter(self.options, schema)


class GeoTiffReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Strips]:
        from pyarrow import fs

        where, name = _open(self.options["path"])
        info = where.get_file_info(name)
        found = [info] if info.type == fs.FileType.File else where.get_file_info(fs.FileSelector(name, recursive=True))
        files = sorted((f.path, f.size) for f in found if f.path.endswith(".tif"))
        return [Strips(runs) for runs in packed(files, int(self.options.get("strips", 1)))]  # a task learns from the file's directory which rows these are

    def read(self, partition: Strips) -> Iterator[pa.RecordBatch]:
        return whole(batch for run in partition.runs for batch in self.pixels(*run))

    def pixels(self, path: str, first: int, last: int) -> Iterator[pa.RecordBatch]:
        """The rows of strips that follow each other."""
        wanted = self.options.get("bands")
        with ranges(path) as read:
            r = tiff.header(read)
            bands = [k for k, d in enumerate(r.descriptions) if d in wanted.split(",")] if wanted else None
            bounds = strip_bounds(r.rows, int(self.options.get("strips", 1)))[first:last]
            if bounds:
                yield from pixel_batches(path, read, bands, bounds[0][0], bounds[-1][1], r)


class GeoTiffWriter(DataSourceWriter):
    """Rows of (file, rows, columns, bands, dtype, data, descriptions): an encoded raster each, whole blocks of bytes."""

    def __init__(self, options: dict, schema: StructType):
        self.options = options

    def write(self, rows: Iterator) -> WriterCommitMessage:
        where, root = _open(self.options["path"])
        where.create_dir(root, recursive=True)
        for row in rows:
            array = np.frombuffer(bytes(row["data"]), row["dtype"]).reshape(row["bands"], row["rows"], row["columns"])
            with where.open_output_stream(f"{root}/.{row['file']}") as out:
                out.write(tiff.write(array, descriptions=row["descriptions"]))
            where.move(f"{root}/.{row['file']}", f"{root}/{row['file']}")
        return WriterCommitMessage()


def rasters(pixels: DataFrame, file: str, rows: int, columns: int, bands: list[str], dtype: str) -> DataFrame:
    """Rows for the geotiff sink: pixel rows (file column, description, y, x, value) put together, a raster a group."""

    def assemble(group: pa.Table) -> pa.Table:
        array = np.zeros((len(bands), rows, columns), dtype)
        number = {b: k for k, b in enumerate(bands)}
        at = np.array([number[d] for d in group.column("description").to_pylist()])
        array[at, group.column("y").to_numpy(), group.column("x").to_numpy()] = group.column("value").to_numpy()
        return pa.table({"file": group.column(file)[:1], "rows": pa.array([rows], pa.int32()), "columns": pa.array([columns], pa.int32()), "bands": pa.array([len(bands)], pa.int32()), "dtype": [dtype], "descriptions": pa.array([bands]), "data": pa.array([array.tobytes()], pa.binary())})

    return pixels.groupBy(file).applyInArrow(assemble, "file string, rows int, columns int, bands int, dtype string, descriptions array<string>, data binary")
