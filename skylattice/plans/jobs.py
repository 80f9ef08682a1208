"""Seasons, manifests and what is left to do."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import utm_zone

#: Steps of a tile, in order, and the tiles that are never registered. Fixed values.
STEPS = ("virtual_dates", "registration", "sharpening", "cleanup")
UNREGISTERED_TILES = ("35SLD",)


def season(years: DataFrame, month: int, day: int, interval: int = 5, margin: int = 31) -> DataFrame:
    """year, output_start, output_end, input_start, input_end, interval: a season ends in its year, images are read a margin around it."""
    end = F.make_date(F.col("year"), F.lit(month), F.lit(day))
    start = F.make_date(F.col("year") - 1, F.lit(month), F.lit(day))
    return years.select("year", start.alias("output_start"), end.alias("output_end"), F.date_sub(start, margin).alias("input_start"), F.date_add(end, margin).alias("input_end"), F.lit(interval).alias("interval"))


def manifest(tiles: DataFrame, steps: DataFrame, args: Column | None = None, registration: bool = True) -> DataFrame:
    """step, tile, args of every step of every tile (both are short lists); without registration, sharpening works on the virtual dates themselves."""
    both = steps.crossJoin(tiles)
    skipped = (F.col("step") == "registration") & (F.col("tile").isin(*UNREGISTERED_TILES) | F.lit(not registration))
    return both.where(~skipped).select("step", "tile", (args if args is not None else F.create_map(F.lit("tile"), F.col("tile"))).alias("args"))


def script(jobs: DataFrame, command: str = "run") -> DataFrame:
    """One line a job."""
    options = F.array_join(F.transform(F.sort_array(F.map_keys("args")), lambda k: F.concat(F.lit("--"), k, F.lit(" "), F.element_at("args", k))), " ")
    return jobs.select("step", "tile", F.concat_ws(" ", F.lit(command), "step", options).alias("line"))


def pending(jobs: DataFrame, done: DataFrame, keys: tuple[str, ...] = ("step", "tile")) -> DataFrame:
    """Jobs that are not done yet."""
    return jobs.join(done.select(*keys).distinct(), list(keys), "left_anti")


def result_suffix(tile: Column, registration: bool = True) -> Column:
    """Suffix of registered results; unregistered tiles, and runs without registration, have none."""
    return F.when(tile.isin(*UNREGISTERED_TILES) | F.lit(not registration), F.lit("")).otherwise(F.lit("_AROP"))


#: Resampling methods that the registration program knows; fixed values.
RESAMPLING = ("NN", "BI", "CC", "AGG", "none")
#: Keys of its parameter file, in their order; fixed values of the format. A side's keys begin with BASE_ or WARP_.
PARAMETER_KEYS = (
    "BASE_LANDSAT", "BASE_FILE_TYPE", "BASE_DATA_TYPE", "BASE_NSAMPLE", "BASE_NLINE", "BASE_PIXEL_SIZE", "BASE_UPPER_LEFT_CORNER", "BASE_UTM_ZONE", "BASE_DATUM",
    "WARP_NBANDS", "WARP_LANDSAT_BAND", "WARP_BAND_DATA_TYPE", "BASE_SATELLITE", "WARP_BASE_MATCH_BAND", "WARP_FILE_TYPE", "WARP_NSAMPLE", "WARP_NLINE", "WARP_PIXEL_SIZE", "WARP_UPPER_LEFT_CORNER", "WARP_UTM_ZONE", "WARP_DATUM", "WARP_SATELLITE",
    "OUT_PIXEL_SIZE", "RESAMPLE_METHOD", "OUT_EXTENT", "OUT_LANDSAT_BAND", "OUT_BASE_MATCH_BAND", "OUT_BASE_POLY_ORDER", "CP_LOG_FILE", "CP_PARAMETERS_FILE",
)


def registration_parameters(scenes: DataFrame, bands: list[str], match_band: str = "B4", resampling: str = "NN", sensor: str = "Sentinel2") -> DataFrame:
    """tile, date, text: the parameter file of each image to be registered.

    scenes: tile, date, name (common start of the image's files), base_file, and
    structs base and warp with driver, dtype_code, columns, rows, pixel, x0, y0, crs.
    """
    if resampling not in RESAMPLING:
        raise ValueError(f"resampling is one of {', '.join(RESAMPLING)}")
    files = lambda names, end: F.concat_ws(" ", *(F.concat("name", F.lit(f"_{b}{end}")) for b in names))

    def side(prefix: str, s: str) -> dict[str, Column]:
        driver = F.when(F.col(f"{s}.driver") == "GTiff", "GEOTIFF").otherwise(F.col(f"{s}.driver"))
        corner = F.concat_ws(", ", f"{s}.x0", f"{s}.y0")
        return {f"{prefix}_FILE_TYPE": driver, f"{prefix}_NSAMPLE": F.col(f"{s}.columns"), f"{prefix}_NLINE": F.col(f"{s}.rows"), f"{prefix}_PIXEL_SIZE": F.col(f"{s}.pixel"), f"{prefix}_UPPER_LEFT_CORNER": corner, f"{prefix}_UTM_ZONE": utm_zone(F.col(f"{s}.crs")), f"{prefix}_DATUM": F.lit(12)}

    values = side("BASE", "base") | side("WARP", "warp") | {
        "BASE_LANDSAT": F.col("base_file"), "BASE_DATA_TYPE": F.col("base.dtype_code"), "BASE_SATELLITE": F.lit(sensor), "WARP_SATELLITE": F.lit(sensor),
        "WARP_NBANDS": F.lit(len(bands)), "WARP_LANDSAT_BAND": files(bands, ".tif"), "WARP_BAND_DATA_TYPE": F.array_join(F.array_repeat(F.col("warp.dtype_code").cast("string"), len(bands)), " "), "WARP_BASE_MATCH_BAND": files([match_band], ".tif"),
        "OUT_PIXEL_SIZE": F.col("warp.pixel"), "RESAMPLE_METHOD": F.lit(resampling), "OUT_EXTENT": F.lit("BASE"), "OUT_LANDSAT_BAND": files(bands, "_AROP.tif"), "OUT_BASE_MATCH_BAND": files([match_band], "_AROP.tif"),
        "OUT_BASE_POLY_ORDER": F.lit(1), "CP_LOG_FILE": F.lit("cp_log.txt"), "CP_PARAMETERS_FILE": F.lit("lndortho.cps_par.ini"),
    }
    lines = [F.concat(F.lit(f"{k} = "), values[k].cast("string")) for k in PARAMETER_KEYS]
    return scenes.select("tile", "date", F.array_join(F.array(F.lit("PARAMETER_FILE"), *lines, F.lit("END")), "\n").alias("text"))


def register(blocks: DataFrame, method: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """blocks (tile, date, band, h, w, data of float64) through a registration method, one image at a time; the default leaves them as they are."""
    if method is None:
        return blocks

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("data")
            h, w = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("h", "w"))
            data = [np.ascontiguousarray(method(np.frombuffer(d.as_buffer(), np.float64).reshape(a, b)), np.float64).tobytes() for d, a, b in zip(batch.column(at), h, w)]
            columns = list(batch.columns)
            columns[at] = pa.array(data, pa.binary())
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return blocks.mapInArrow(apply, blocks.schema)


def phase_shift(base: np.ndarray, image: np.ndarray) -> tuple[int, int]:
    """Whole-pixel shift of image against base by phase correlation."""
    cross = np.fft.fft2(base) * np.conj(np.fft.fft2(image))
    peak = np.fft.ifft2(cross / np.maximum(np.abs(cross), 1e-12)).real
    y, x = np.unravel_index(int(peak.argmax()), peak.shape)
    return tuple(int(s - n if s > n // 2 else s) for s, n in zip((y, x), peak.shape))


def aligned(base: np.ndarray, image: np.ndarray) -> np.ndarray:
    """image moved by whole pixels onto base; pixels that nothing moves to are NaN."""
    dy, dx = phase_shift(base, image)
    out = np.full(image.shape, np.nan)
    (h, w), at = image.shape, lambda d, n: (slice(max(d, 0), n + min(d, 0)), slice(max(-d, 0), n - max(d, 0)))
    (ty, fy), (tx, fx) = at(dy, h), at(dx, w)
    out[ty, tx] = image[fy, fx]
    return out


def register_to(blocks: DataFrame, base: DataFrame) -> DataFrame:
    """blocks (tile, date, band, h, w, data) moved onto the base image (tile, h, w, data) of their tile, one image at a time."""
    both = blocks.join(base.select("tile", F.col("data").alias("_base")), "tile").select(*blocks.columns, "_base")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("data")
            h, w = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("h", "w"))
            read = lambda d, a, b: np.frombuffer(d.as_buffer(), np.float64).reshape(a, b)
            data = [aligned(read(o, a, b), read(d, a, b)).tobytes() for o, d, a, b in zip(batch.column(batch.num_columns - 1), batch.column(at), h, w)]
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(data, pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return both.mapInArrow(apply, blocks.schema)


def clean_up(spark, path: str, confirmed: bool = False) -> bool:
    """Deletes a tile's intermediate folder, only when that is confirmed."""
    if not confirmed:
        return False
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True))
