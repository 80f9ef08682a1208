"""The chains, and blocks against pixels."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylattice.operators import blocks, ml, spatial
from skylattice.plans import chains


@pytest.mark.parametrize("ratio,size", [(2.0, 7), (3.0, 5), (6.0, 16)])
def test_block_convolution(spark, ratio, size):
    rng = np.random.default_rng(0)
    a = rng.normal(size=(23, 19))
    rows = [("t", "B4", y, x, float(a[y, x])) for y in range(23) for x in range(19)]
    pixels = spark.createDataFrame(rows, "tile string, band string, y int, x int, value double")
    kernel = spatial.kernel_for(ratio)
    made = blocks.to_blocks(pixels, size, 23, 19)
    assert made.count() == -(-23 // size) * -(-19 // size)
    got = {(r["y"], r["x"]): r["value"] for r in blocks.to_pixels(blocks.high_pass(made, size, 23, 19, kernel), size).collect()}
    want = {(r["y"], r["x"]): r["hpf"] for r in spatial.high_pass(pixels, ["tile", "band"], 23, 19, kernel).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)


def cube_rows(rng, bands, days, n=6):
    return [("T", datetime.date(2024, 1, d), b, y, x, int(rng.integers(0, 9000))) for d in days for b in bands for y in range(n) for x in range(n)]


def test_virtual_dates(spark):
    rng = np.random.default_rng(0)
    bands, days = ("B2", "B3", "B4", "B8"), (1, 6, 9, 17, 25)
    rows = cube_rows(rng, bands, days)
    rows += [("T", datetime.date(2024, 1, 20), "B2", y, x, 1) for y in range(6) for x in range(6)]  # lacks bands: dropped
    pixels = spark.createDataFrame(rows, "tile string, date date, band string, y int, x int, value int")
    clouds = spark.createDataFrame([("T", datetime.date(2024, 1, 9), 0, 0, 1)] + [("T", datetime.date(2024, 1, d), 0, 1, 1) for d in (1, 6, 9)], "tile string, date date, y int, x int, clm int")
    sea = spark.createDataFrame([("T", y, x, int(y == 5)) for y in range(6) for x in range(6)], "tile string, y int, x int, flag int")
    out = chains.virtual_dates(pixels, clouds, sea, "2024-01-01", "2024-01-01", "2024-01-26", 5, bands)
    got = {(r["band"], r["y"], r["x"], r["t"]): r["value"] for r in out.collect()}
    assert len(got) == 4 * 36 * 6
    value = {(b, y, x, d.day): v for _, d, b, y, x, v in rows}
    for (b, y, x, t), v in got.items():
        clear = [d for d in days if not ((y, x) == (0, 0) and d == 9) and not ((y, x) == (0, 1) and d in (1, 6, 9))]
        want = 0 if y == 5 or len(clear) < 3 else int(np.interp(t, clear, [value[b, y, x, d] for d in clear]))
        assert v == want, (b, y, x, t)


def test_sharpen_to_map(spark):
    rng = np.random.default_rng(1)
    bands = ("B2", "B3", "B4", "B8", "B5", "B6", "B7", "B8A", "B11", "B12")
    rows = [("T", t, b, y, x, int(rng.integers(100, 9000))) for t in (1, 6, 11) for b in bands for y in range(8) for x in range(8)]
    cube = spark.createDataFrame(rows, "tile string, t int, band string, y int, x int, value int")
    mask = lambda f: spark.createDataFrame([("T", y, x, int(f(y, x))) for y in range(8) for x in range(8)], "tile string, y int, x int, flag int")
    sharp = chains.sharpened(cube, mask(lambda y, x: x == 7 and y == 0), mask(lambda y, x: y == 7), 8, 8)
    found = sharp.collect()
    assert len(found) == len(rows) and all(r["value"] == -10000 for r in found if r["y"] == 7) and all(r["value"] >= 0 for r in found if r["y"] != 7)
    kept = {(t, b, y, x): v for _, t, b, y, x, v in rows}
    assert all(r["value"] == kept[r["t"], r["band"], r["y"], r["x"]] for r in found if r["band"] == "B11" and r["y"] != 7)

    table = chains.temporal_features(cube, ["B3", "B4", "B8", "B11"])
    columns = [c for c in table.columns if c not in ("tile", "y", "x")]
    assert len(columns) == 9 * 7 and columns[0] == "min B3" and table.count() == 64
    labels = spark.createDataFrame([("T", "train" if x < 4 else "test", y, x, 1 + y % 3) for y in range(8) for x in range(8)], "tile string, split string, y int, x int, label int")
    model, overall, classes = chains.train_and_evaluate(table, labels, columns, ml.random_forest(trees=5, depth=4))
    assert overall.head()["n"] == 32 and classes.count() == 3
    land = chains.class_map(model, table, columns, mask(lambda y, x: y != 0))
    rows = {(r["y"], r["x"]): r for r in land.collect()}
    assert len(rows) == 64 and all((rows[0, x]["label"], rows[0, x]["prob2"]) == (0, 100) for x in range(8))
    placed = land.withColumn("px", F.lit(300000.0) + F.col("x") * 10).withColumn("py", F.lit(4720000.0) - F.col("y") * 10)
    assert chains.mosaic(placed, F.lit(0)).count() == 56


def test_write_strips(spark, tmp_path):
    path = str(tmp_path / "map")
    frame = lambda v, strips: spark.createDataFrame([("T", s, v) for s in strips], "tile string, strip int, v int")
    chains.write_strips(frame(1, [0, 1, 2]), path)
    chains.write_strips(frame(2, [1]), path)
    assert {r["strip"]: r["v"] for r in spark.read.parquet(path).collect()} == {0: 1, 1: 2, 2: 1}


def test_write_strips_folders(spark, tmp_path):
    """Many small strips share a bounded number of folders; strips that are not replaced stay, whichever folder they share."""
    path = str(tmp_path / "map")
    cells = spark.range(400).select(F.expr("nullif(id, 7)").alias("tile"), F.explode(F.array(*map(F.lit, range(3)))).alias("strip"), (F.col("id") % 5).cast("double").alias("v"))
    chains.write_strips(cells, path)
    chains.write_strips(cells.where("strip = 1 AND (tile % 2 = 1 OR tile IS NULL)").withColumn("v", F.col("v") + 10).limit(150), path)
    chains.write_strips(cells.where("tile = 3").limit(0), path)
    back = spark.read.parquet(path)
    assert len([p for p in (tmp_path / "map").iterdir() if p.is_dir()]) <= chains.STRIP_FOLDERS and dict(back.dtypes)["tile"] == "bigint"
    rows = [(r["tile"], r["strip"], r["v"]) for r in back.collect()]
    assert len(rows) == len({r[:2] for r in rows}) == 1200
    changed = [r for r in rows if r[2] >= 10]
    assert len(changed) == 150 and all(s == 1 and (t is None or t % 2) for t, s, _ in changed)
    assert all(v % 10 == (7 if t is None else t) % 5 for t, _, v in rows)
    own = spark.read.parquet(path).where("strip = 2").drop(chains.STRIP_FOLDER).withColumn("v", F.lit(-1.0))
    chains.write_strips(own, path)  # rows that are read from the table itself
    assert spark.read.parquet(path).groupBy("strip").agg(F.min("v"), F.max("v"), F.count("*")).where("strip = 2").head()[1:] == (-1.0, -1.0, 400)
    with pytest.raises(ValueError):
        chains.write_strips(cells.withColumn("v", F.col("v").cast("int")), path)
