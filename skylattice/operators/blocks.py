"""Rasters in blocks, for volumes where a row a pixel is too fine.

A block row holds h x w float64 pixels.  A convolution needs a halo: every block
sends its edges to the neighbours that they reach (copies of border pixels, a
few percent of the data), each block is put together with what it got and
convolved by cumulative sums.  Memory of a task is one block and its halo.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spatial import Kernel

BLOCK = "tile string, band string, by int, bx int, h int, w int, data binary"


def to_blocks(pixels: DataFrame, size: int, rows: int, columns: int) -> DataFrame:
    """Blocks of pixel rows (tile, band, y, x, value); absent pixels are NaN."""

    def assemble(group: pa.Table) -> pa.Table:
        by, bx = group.column("by")[0].as_py(), group.column("bx")[0].as_py()
        h, w = min(size, rows - by * size), min(size, columns - bx * size)
        a = np.full((h, w), np.nan)
        a[group.column("y").to_numpy() - by * size, group.column("x").to_numpy() - bx * size] = group.column("value").to_numpy()
        return pa.table({**{c: group.column(c)[:1] for c in ("tile", "band", "by", "bx")}, "h": pa.array([h], pa.int32()), "w": pa.array([w], pa.int32()), "data": pa.array([a.tobytes()], pa.binary())})

    keyed = pixels.select("tile", "band", F.floor(F.col("y") / size).cast("int").alias("by"), F.floor(F.col("x") / size).cast("int").alias("bx"), "y", "x", F.col("value").cast("double").alias("value"))
    return keyed.groupBy("tile", "band", "by", "bx").applyInArrow(assemble, BLOCK)


def to_pixels(blocks: DataFrame, size: int) -> DataFrame:
    """Pixel rows of blocks."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                a = np.frombuffer(r["data"], np.float64)
                y, x = np.divmod(np.arange(len(a)), r["w"])
                yield pa.RecordBatch.from_pydict({"tile": [r["tile"]] * len(a), "band": [r["band"]] * len(a), "y": pa.array((y + r["by"] * size).astype(np.int32)), "x": pa.array((x + r["bx"] * size).astype(np.int32)), "value": pa.array(a)})

    return blocks.select("tile", "band", "by", "bx", "h", "w", "data").mapInArrow(spread, "tile string, band string, y int, x int, value double")


def box_high_pass(wide: np.ndarray, kernel: Kernel) -> np.ndarray:
    """High-pass of the inner part of an array that is wider by the kernel's half on each side."""
    n, c = kernel.size, kernel.size // 2
    total = np.zeros((wide.shape[0] - n + 1, wide.shape[1] - n + 1))
    rows = np.lib.stride_tricks.sliding_window_view(wide, n, 0).sum(-1)
    total += np.lib.stride_tricks.sliding_window_view(rows, n, 1).sum(-1)
    at = c - kernel.shift
    return (kernel.gain + 1) * wide[at : at + total.shape[0], at : at + total.shape[1]] - total


def high_pass(blocks: DataFrame, size: int, rows: int, columns: int, kernel: Kernel) -> DataFrame:
    """Blocks of the high-pass image; the raster's edge is mirrored."""
    pad = kernel.size // 2
    if pad > size or pad > min(rows, columns):
        raise ValueError("the kernel reaches beyond a block")
    n_by, n_bx = -(-rows // size), -(-columns // size)
    schema = "tile string, band string, by int, bx int, y0 int, x0 int, h int, w int, data binary"

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                a = np.frombuffer(r["data"], np.float64).reshape(r["h"], r["w"])
                y0, x0 = r["by"] * size, r["bx"] * size
                out = []
                for dy in (-1, 0, 1):
                    for dx in (-1, 0, 1):
                        by, bx = r["by"] + dy, r["bx"] + dx
                        if not (0 <= by < n_by and 0 <= bx < n_bx):
                            continue
                        # the part of this block that lies in the neighbour's halo
                        top, bottom = max(y0, by * size - pad), min(y0 + r["h"], min(rows, (by + 1) * size) + pad)
                        left, right = max(x0, bx * size - pad), min(x0 + r["w"], min(columns, (bx + 1) * size) + pad)
                        if top < bottom and left < right:
                            part = np.ascontiguousarray(a[top - y0 : bottom - y0, left - x0 : right - x0])
                            out.append((r["tile"], r["band"], by, bx, top, left, bottom - top, right - left, part.tobytes()))
                names = [c.split()[0] for c in schema.split(", ")]
                yield pa.RecordBatch.from_pylist([dict(zip(names, o)) for o in out], schema=pa.schema([("tile", pa.string()), ("band", pa.string()), *((c, pa.int32()) for c in names[2:8]), ("data", pa.binary())]))

    def convolve(group: pa.Table) -> pa.Table:
        by, bx = group.column("by")[0].as_py(), group.column("bx")[0].as_py()
        h, w = min(size, rows - by * size), min(size, columns - bx * size)
        top, left = by * size - pad, bx * size - pad
        wide = np.full((h + 2 * pad, w + 2 * pad), np.nan)
        for r in group.to_pylist():
            wide[r["y0"] - top : r["y0"] - top + r["h"], r["x0"] - left : r["x0"] - left + r["w"]] = np.frombuffer(r["data"], np.float64).reshape(r["h"], r["w"])
        # mirrored beyond the raster's edges
        y, x = np.arange(top, top + h + 2 * pad), np.arange(left, left + w + 2 * pad)
        y, x = (np.where(i < 0, -1 - i, np.where(i >= n, 2 * n - 1 - i, i)) for i, n in ((y, rows), (x, columns)))
        wide = wide[np.ix_(y - top, x - left)]
        return pa.table({**{c: group.column(c)[:1] for c in ("tile", "band", "by", "bx")}, "h": pa.array([h], pa.int32()), "w": pa.array([w], pa.int32()), "data": pa.array([np.ascontiguousarray(box_high_pass(wide, kernel)).tobytes()], pa.binary())})

    parts = blocks.select("tile", "band", "by", "bx", "h", "w", "data").mapInArrow(share, schema)
    return parts.groupBy("tile", "band", "by", "bx").applyInArrow(convolve, BLOCK)
