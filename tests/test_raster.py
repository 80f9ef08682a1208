"""Operators against numpy."""

import datetime
import io
import re

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from skylattice.functions import columns as C
from skylattice.operators import catalog, features, merge, metrics, ml, spatial, temporal
from skylattice.plans import jobs
from skylattice.schema import wrap_int16, wrap_uint16
from skylattice.sources import geotiff, tables, tiff


def pixels(spark, arrays, extra=None):
    rows = [(t, y, x, float(a[y, x])) + ((bool(extra[t][y, x]),) if extra else ()) for t, a in enumerate(arrays) for y in range(a.shape[0]) for x in range(a.shape[1])]
    return spark.createDataFrame(rows, "tile int, y int, x int, value double" + (", water boolean" if extra else ""))


def image(rows, column, shape, tiles):
    out = np.full((tiles, *shape), np.nan)
    for r in rows.collect():
        if r[column] is not None:
            out[r["tile"], r["y"], r["x"]] = r[column]
    return out


def convolved(a, kernel):
    """Same-size convolution with a mirrored edge, as a plain sum."""
    n, c = kernel.size, kernel.size // 2
    k = -np.ones((n, n))
    r = int(round(n / 2))
    k[r, r] = kernel.gain
    wide = np.pad(a, c, mode="symmetric")
    flipped = k[::-1, ::-1]
    return np.array([[(wide[i : i + n, j : j + n] * flipped).sum() for j in range(a.shape[1])] for i in range(a.shape[0])])


@pytest.mark.parametrize("ratio", [2.0, 3.0, 4.0, 6.0, 8.0, 10.0])
def test_high_pass(spark, ratio):
    rng = np.random.default_rng(0)
    arrays = [rng.normal(size=(9, 12)) for _ in range(2)]
    kernel = spatial.kernel_for(ratio)
    got = image(spatial.high_pass(pixels(spark, arrays), ["tile"], 9, 12, kernel), "hpf", (9, 12), 2)
    assert np.allclose(got, [convolved(a, kernel) for a in arrays])


def test_kernel_for():
    assert [spatial.kernel_for(r).size for r in (1.5, 2.5, 3.5, 5.5, 7.5, 9.5, 40)] == [5, 7, 9, 11, 13, 15, 15]
    assert [spatial.kernel_for(r).shift for r in (2, 3, 4, 6, 8, 10)] == [0, 1, 0, 1, 0, 1]
    with pytest.raises(ValueError):
        spatial.kernel_for(1.0)


def test_fusion(spark):
    rng = np.random.default_rng(1)
    pan, ms = rng.uniform(100, 900, (10, 10)), rng.uniform(100, 900, (10, 10))
    water = np.zeros((10, 10), bool)
    water[0, 0] = water[9, 5] = True
    kernel = spatial.kernel_for(2.0)
    detail = convolved(pan, kernel)
    strict = convolved(np.where(water, np.nan, pan), kernel)
    low = np.where(water, np.nan, ms)
    std = np.nanstd(low, ddof=1)
    f = ms + detail * (std / np.nanstd(strict, ddof=1) * kernel.weight)
    dry = np.where(water, np.nan, f)
    expected = f - np.nanmean(dry) * (std / np.nanstd(dry)) + np.nanmean(low)
    got = spatial.fuse(pixels(spark, [pan], [water]), pixels(spark, [ms]).withColumn("band", F.lit("B5")), ["tile"], 10, 10)
    assert np.allclose(image(got, "value", (10, 10), 1)[0], expected)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 12, 13])
def test_interpolate(spark, n):
    rng = np.random.default_rng(n)
    t = np.sort(rng.choice(np.arange(1, 40), n, replace=False))
    v = rng.integers(0, 5000, n)
    rows = [(1, int(a), int(b)) for a, b in zip(t, v)] + [(1, 50, None), (2, 5, None)]
    days = np.arange(0, 60, 4)
    for least in (3, 13):
        got = temporal.interpolate(spark.createDataFrame(rows, "k int, t int, v int"), ["k"], "t", "v", F.array(*(F.lit(int(d)) for d in days)), least)
        found = {(r["k"], r["t"]): r["value"] for r in got.collect()}
        expected = np.interp(days, t, v) if n >= least else np.zeros(len(days))
        assert np.allclose([found[1, d] for d in days], expected)
        assert all(found[2, d] == 0 for d in days)


@pytest.mark.parametrize("n", [1, 2, 9, 10])
def test_statistics(spark, n):
    v = np.random.default_rng(n).normal(size=n)
    rows = [("a", float(x)) for x in v] + [("a", float("nan")), ("a", None)]
    r = temporal.statistics(spark.createDataFrame(rows, "k string, v double"), ["k"], "v").head()
    expected = [v.min(), *np.percentile(v, [10, 25, 50, 75, 90]), v.max(), v.mean(), v.std()]
    assert np.allclose([r[s] for s in temporal.STATISTICS], expected)
    one = temporal.statistics(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", ("p50", "std"))
    assert one.columns == ["k", "p50", "std"]


def test_clip_and_index(spark):
    rows = spark.createDataFrame([(-5.0, 1.0), (20000.0, -20000.0), (float("nan"), 1.0), (5000.0, 5000.0), (0.0, 0.0), (None, 1.0)], "a double, b double")
    got = rows.select(C.normalize(F.col("a")).alias("n"), C.normalized_difference(F.col("a"), F.col("b")).alias("d")).collect()
    assert [r["n"] for r in got] == [0.0, 1.0, None, 0.5, 0.0, None]
    assert got[1]["d"] == 0.0 and got[3]["d"] == 0.5 and got[4]["d"] == 0.0 and got[2]["d"] is None


def test_wrap(spark):
    v = [-10000, 70000, 40000, -1, 0, 65535, -40000]
    got = spark.createDataFrame([(x,) for x in v], "v long").select(wrap_uint16(F.col("v")).alias("u"), wrap_int16(F.col("v")).alias("i")).collect()
    with np.errstate(over="ignore"):
        assert [r["u"] for r in got] == np.array(v).astype(np.uint16).tolist()
        assert [r["i"] for r in got] == np.array(v).astype(np.int16).tolist()


def test_top_two_ties(spark):
    got = spark.createDataFrame([([0.2, 0.5, 0.5, 0.1],), ([0.3, 0.3, 0.3, 0.1],)], "p array<double>").select(*ml.best_two(F.col("p"))).collect()
    assert tuple(got[0]) == (3, 50, 2, 50) and tuple(got[1])[::2] == (3, 2)


def test_predict_map_sea_and_missing(spark):
    rows = spark.createDataFrame([(i, float(i % 2), i % 2, i % 5 == 0) for i in range(60)], "id int, f double, label int, sea boolean")
    rows = features.for_classifier(rows.withColumn("f", F.when(F.col("id") == 7, F.lit(float("nan"))).otherwise(F.col("f"))), ["f"])
    model = ml.random_forest(trees=3, depth=2).fit(rows)
    got = {r["id"]: r for r in ml.predict_map(model, rows, ["id"], "sea", "missing").collect()}
    assert len(got) == 60 and (got[5]["label"], got[5]["prob"], got[5]["label2"], got[5]["prob2"]) == (0, 100, 0, 100)
    assert got[7]["label"] == 0 and got[1]["label"] == 2


def test_duplicate_merge(spark):
    rows = [("d1", "a", 0, -10000), ("d1", "a", 1, 5), ("d1", "b", 0, 7), ("d1", "b", 1, 8), ("d1", "c", 0, 9), ("d1", "c", 1, -10000), ("d2", "a", 0, -10000), ("d2", "b", 0, -10000)]
    got = merge.merge_duplicates(spark.createDataFrame(rows, "d string, acq string, x int, v int"), ["d"], "acq", ["x"], F.col("v") == -10000, "v")
    found = {(r["d"], r["x"]): (r["v"], r["base"], r["taken_from"]) for r in got.collect()}
    assert found == {("d1", 0): (7, "b", "b"), ("d1", 1): (8, "b", "b"), ("d2", 0): (-10000, "a", "a")}


def test_mosaic(spark):
    rows = [(0, 1, 50, 0), (0, 2, 50, 1), (1, 0, 99, 0), (1, 3, 10, 1), (2, 1, 0, 0), (3, 4, 20, 0), (3, 5, 30, 1)]
    cells = spark.createDataFrame(rows, "c int, class int, prob int, source_rank int")
    got = spatial.mosaic(cells, ["c"], spark.range(5).select(F.col("id").cast("int").alias("c")))
    assert {r["c"]: (r["class"], r["prob"]) for r in got.collect()} == {0: (1, 50), 1: (3, 10), 2: (0, 0), 3: (5, 30), 4: (0, 0)}


def test_metrics(spark):
    pairs = [(1, 1)] * 5 + [(1, 3)] * 2 + [(3, 3)] * 4 + [(7, 1)] + [(3, 9)]
    counts = metrics.confusion(spark.createDataFrame(pairs, "gt int, pred int"))
    g, p = np.array(pairs).T
    po, pe = (g == p).mean(), sum((g == c).mean() * (p == c).mean() for c in set(g) | set(p))
    o = metrics.overall(counts).head()
    assert np.allclose([o["accuracy"], o["kappa"], o["error_rate"]], [po, (po - pe) / (1 - pe), 1 - po])
    by = {r["class"]: r for r in metrics.per_class(counts, spark.createDataFrame([(1,), (3,), (8,)], "class int")).collect()}
    assert by[1]["ua"] == round(500 / 6, 2) and by[3]["pa"] == 80.0 and by[7]["pa"] is None and by[8]["ua"] is None
    assert metrics.filled(counts).count() == 16
    assert metrics.with_margins(counts).where("gt is null and pred is null").head()["n"] == len(pairs)


def test_labelled_and_union(spark):
    f = spark.createDataFrame([(1, 0.5), (2, float("nan")), (3, 0.1)], "id int, f double")
    lab = spark.createDataFrame([(1, 3), (2, 1), (3, 0)], "id int, label int")
    assert [tuple(r) for r in features.labelled(f, lab, ["id"], ["f"]).collect()] == [(1, 0.5, 2)]


def test_catalog(spark):
    files = spark.createDataFrame([("/a/S2A_20240105-10_L2A_T34ABC/S_x_FRE_B8.tif",), ("/a/S2A_20240105-10_L2A_T34ABC/S_x_FRE_B8A.tif",), ("/a/S2A_20240105-10_L2A_T34ABC/MASKS/S_CLM_R1.tif",), ("/a/S2A_20240106-10_L2A_T34ABC/x.txt",)], "path string")
    s = catalog.scene_list(files).collect()
    assert len(s) == 1 and s[0]["tile"] == "34ABC" and s[0]["date"] == datetime.date(2024, 1, 5)
    assert {r["b"] for r in files.select(catalog.band_of(F.col("path")).alias("b")).collect()} >= {"B8", "B8A", "CLM_R1"}
    keyed = files.withColumn("k", F.lit("t"))
    assert catalog.exactly_one(keyed, "k", r"_B8\.tif$").head()["path"].endswith("_B8.tif")
    with pytest.raises(Exception, match="files that match"):
        catalog.exactly_one(keyed, "k", r"\.tif$").collect()
    with pytest.raises(Exception, match="no mask"):
        t = spark.createDataFrame([("a", 0, 0)], "tile string, y int, x int")
        catalog.with_fallback_mask(t, spark.createDataFrame([], "tile string, y int, x int, flag int"), ["b"]).collect()


@pytest.mark.parametrize("source,target", [((4, 6), (8, 12)), ((8, 8), (5, 3)), ((3, 5), (7, 4)), ((5, 5), (5, 5))])
def test_resample(spark, source, target):
    a = np.arange(source[0] * source[1], dtype=float).reshape(source)
    got = image(spatial.resample_nearest(pixels(spark, [a]), ["tile"], source, target), "value", target, 1)[0]
    expected = a[np.arange(target[0])[:, None] * source[0] // target[0], np.arange(target[1]) * source[1] // target[1]]
    assert np.array_equal(got, expected)


@pytest.mark.parametrize("dtype", list(tiff.SAMPLE))
def test_tiff(dtype):
    rng = np.random.default_rng(0)
    a = rng.integers(0, 120, (3, 37, 11)).astype(dtype)
    data = tiff.write(a, (300000.0, 10.0, 0.0, 4720000.0, 0.0, -10.0), "UTM zone 34N", ["B2", "B8 <x>", "B8A"], -10000)
    r = tiff.header(data)
    assert (r.rows, r.columns, r.bands, r.dtype, r.crs, r.descriptions, r.geo[0], r.geo[5], r.nodata) == (37, 11, 3, dtype, "UTM zone 34N", ["B2", "B8 <x>", "B8A"], 300000.0, -10.0, -10000.0)
    assert np.array_equal(tiff.read_rows(data, r, 0, 37), a)
    assert np.array_equal(tiff.read_rows(data, r, 5, 20, [2]), a[[2], 5:20])
    with pytest.raises(ValueError):
        tiff.write(a.reshape(-1))


def test_geotiff_source(spark, tmp_path):
    a = np.random.default_rng(0).integers(0, 9000, (2, 23, 7)).astype("uint16")
    (tmp_path / "x.tif").write_bytes(tiff.write(a, descriptions=["B4", "B8"]))
    spark.dataSource.register(geotiff.GeoTiffSource)
    rows = spark.read.format("geotiff").option("strips", 5).load(str(tmp_path))
    assert rows.rdd.getNumPartitions() == 5
    for found in (rows, geotiff.read(spark, str(tmp_path))):
        got = np.zeros_like(a)
        for r in found.collect():
            got[r["band"] - 1, r["y"], r["x"]] = r["value"]
        assert np.array_equal(got, a)
    assert geotiff.read(spark, str(tmp_path), ["B8"]).count() == 23 * 7
    m = geotiff.metadata(spark, str(tmp_path)).head()
    assert (m["rows"], m["columns"], m["descriptions"]) == (23, 7, ["B4", "B8"])
    n = geotiff.read_normalized(spark, str(tmp_path), ["B8", "B11"]).where("y = 3 and x = 2").head()
    assert abs(n["B8"] - a[1, 3, 2] / 10000) < 1e-9 and n["B11"] == 0.0


def test_npy_and_sheet(spark, tmp_path):
    buf = io.BytesIO()
    np.save(buf, np.arange(12.0).reshape(4, 3))
    (tmp_path / "f.npy").write_bytes(buf.getvalue())
    got = tables.read_npy(spark, str(tmp_path)).orderBy("row").collect()
    assert [r["values"] for r in got] == np.arange(12.0).reshape(4, 3).tolist()
    import zipfile

    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "n.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Code</t></si><si><t>Abbreviation</t></si><si><t>WHT</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row><row><c r="A2"><v>1</v></c><c r="B2" t="s"><v>2</v></c></row></sheetData></worksheet>')
    assert [tuple(r) for r in tables.read_nomenclature(spark, str(tmp_path / "n.xlsx")).collect()] == [(0, "WHT")]
    (tmp_path / "n.csv").write_text("Code,Abbreviation\n1,WHT\n2,MAI\n")
    assert [r["abbreviation"] for r in tables.read_nomenclature(spark, str(tmp_path / "n.csv")).collect()] == ["WHT", "MAI"]


def test_image_folder(spark, tmp_path):
    for c in ("a", "b"):
        (tmp_path / c).mkdir()
        for k in range(20):
            (tmp_path / c / f"{k}.png").write_bytes(b"x")
    rows = tables.image_folder(spark, str(tmp_path)).select("class", "split").collect()
    assert len(rows) == 40 and {r["class"] for r in rows} == {"a", "b"} and 1 <= sum(r["split"] == "validation" for r in rows) <= 20


def test_plans(spark):
    blocks = spark.createDataFrame([("t", 2, 2, bytearray(np.arange(4.0).tobytes()))], "tile string, h int, w int, data binary")
    got = jobs.register(blocks, lambda a: a.T).head()["data"]
    assert np.frombuffer(bytes(got), np.float64).tolist() == [0, 2, 1, 3]
    assert jobs.register(blocks).head()["data"] == blocks.head()["data"]
    a = np.random.default_rng(0).normal(size=(16, 16))
    assert jobs.phase_shift(np.roll(a, (2, -3), (0, 1)), a) == (2, -3)
    assert not jobs.clean_up(spark, "/nowhere")


def test_strips_do_not_change_results(spark):
    assert geotiff.strip_bounds(10, 3) == [(0, 3), (3, 6), (6, 10)] and geotiff.strip_bounds(2, 18) == [(0, 1), (1, 2)]


def test_stream(spark, tmp_path):
    from skylattice.streaming import scenes

    src = spark.createDataFrame([("a", datetime.datetime(2024, 1, d, 5), float(d)) for d in (1, 1, 2, 9)], "k string, ts timestamp, v double")
    src.write.parquet(str(tmp_path / "in"))
    out = scenes.daily(scenes.observations(spark, str(tmp_path / "in"), "k string, ts timestamp, v double"), "ts", ["k"], "v")
    q = out.writeStream.outputMode("complete").format("memory").queryName("daily").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    assert {(r["day"].day, r["n"]) for r in spark.sql("select * from daily").collect()} == {(1, 2), (2, 1), (9, 1)}


def test_natural_key(spark):
    names = ["S2_9_2", "S2_10_1", "S2_9_10", "a", "", "10", "9", "S2_9", "a007b2", "a7b10", "x99999999999999999999999"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").orderBy(*C.natural_key(F.col("n"))).collect()]
    key = lambda n: [int(x) if x.isdigit() else x for x in re.split(r"(\d+)", n)]
    assert got == sorted(names, key=key)


def test_forest_after_an_observation(spark):
    """A forest fresh from training scores although the session has something in it that no task can take."""
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 5
    rows = spark.range(60).select((F.col("id") % 3).cast("int").alias("label"), (F.col("id") % 2 == 0).alias("sea"), "id", array_to_vector(F.array((F.col("id") % 3).cast("double"), F.lit(1.0))).alias("features"))
    assert ml.predict_map(ml.random_forest(trees=3, depth=3).fit(rows), rows, ["id"], sea="sea").count() == 60


def test_ranged_reads(spark, tmp_path):
    """Strips, headers and normalised reads against the arrays; no read takes the whole file."""
    rng = np.random.default_rng(3)
    a = rng.integers(0, 20_000, (2, 301, 40)).astype(np.uint16)
    data = tiff.write(a, descriptions=["B4", "B8"])
    (tmp_path / "one.tif").write_bytes(data)
    taken = []
    read = lambda at, n: taken.append(n) or data[at : at + n]
    r = tiff.header(read)
    assert sum(taken) < 2_000 and np.array_equal(tiff.read_rows(read, r, 100, 120), a[:, 100:120])
    rows = geotiff.strips(spark, str(tmp_path), ["B8", "B11"], 7).collect()
    assert len(rows) == 301 * 40 and all(x["B8"] == a[1, x["y"], x["x"]] and x["B11"] is None and x["strip"] == min(x["y"] // 43, 6) for x in rows)
    fused = geotiff.read_normalized(spark, str(tmp_path), ["B4", "B8"], parts=7, indices=("NDVI",)).where("y = 200 and x = 3").head()
    b4, b8 = (min(1.0, v / 10000) for v in a[:, 200, 3].tolist())
    assert abs(fused["NDVI"] - ((b8 - b4) / (b8 + b4) + 1) / 2) < 1e-9


def test_aligned():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(20, 30))
    got = jobs.aligned(base, np.roll(base, (-3, 5), (0, 1)))
    assert np.array_equal(got[3:, :-5], base[3:, :-5]) and np.isnan(got[:3]).all() and np.isnan(got[:, -5:]).all()


def test_small_strips_share_partitions(spark, tmp_path):
    """A task for each strip of thousands of small files never ends; all pixels come, also of files with fewer rows than strips."""
    rng = np.random.default_rng(5)
    made = {f"f{k:03}.tif": rng.normal(size=(2, 1 + k % 9, 2 + k % 3)) for k in range(250)}
    for name, a in made.items():
        (tmp_path / name).write_bytes(tiff.write(a, descriptions=["B4", "B8"]))
    spark.dataSource.register(geotiff.GeoTiffSource)
    for bands, options in (([0, 1], {}), ([1], {"bands": "B8"})):
        rows = spark.read.format("geotiff").options(strips=3, **options).load(str(tmp_path))
        assert rows.rdd.getNumPartitions() <= 2 * geotiff.PACKS
        got = sorted((r["path"].rsplit("/", 1)[1], r["band"] - 1, r["y"], r["x"], r["value"]) for r in rows.collect())
        assert got == sorted((name, b, y, x, a[b, y, x]) for name, a in made.items() for b in bands for y in range(a.shape[1]) for x in range(a.shape[2]))
    big, small = [("big", 1 << 33)], [(str(k), 100) for k in range(5000)]
    packs = geotiff.packed([*big, *small], 18)
    assert sorted((f, k) for p in packs for f, a, b in p for k in range(a, b)) == sorted((f, k) for f, _ in [*big, *small] for k in range(18))
    assert all(len(p) == 1 and p[0][2] - p[0][1] == 1 for p in packs[:17]) and len(packs) < 30
