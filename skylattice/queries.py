"""One query for each operator over the star-schema tables, with the same in SQL.

The tables stand in for rasters: an event is an observation (pixel: user, band:
event type, day: date of ts), an embedding of 64 numbers an 8 x 8 raster or 64
class scores, a line item a pixel of several bands, parts a map.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import columns as C
from .operators import catalog, features, merge, metrics, ml, spatial, temporal
from .plans import jobs
from .schema import wrap_int16, wrap_uint16

TYPES = ["click", "error", "purchase", "signup", "view"]


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _r6(*names: str) -> list[Column]:
    """Doubles on a lattice that both engines round alike."""
    return [F.round(n, 6).alias(n) for n in names]


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"), "value")


def _start(rows: DataFrame) -> DataFrame:
    return rows.agg(F.min("day").alias("start"), F.max("day").alias("end"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, dates: tuple[str, ...] = ()):
    """Registers a query under its name, with its SQL. dates: columns given as ISO text, which every client reads alike."""

    def put(f):
        QUERIES[f.__name__] = (lambda spark, sf: f(spark, sf).withColumns({c: F.col(c).cast("string") for c in dates})) if dates else f
        if sql:
            ORACLE_SQL[f.__name__] = f"SELECT * REPLACE ({', '.join(f'{c}::DATE::VARCHAR AS {c}' for c in dates)}) FROM ({sql})" if dates else sql
        return f

    return put


# --- time series -----------------------------------------------------------------

_STATS = """min({v}) AS min, quantile_cont({v}, 0.1) AS p10, quantile_cont({v}, 0.25) AS p25, quantile_cont({v}, 0.5) AS p50, quantile_cont({v}, 0.75) AS p75,
  quantile_cont({v}, 0.9) AS p90, max({v}) AS max, avg({v}) AS mean, stddev_pop({v}) AS std"""
_ROUND9 = ", ".join(f"round({s}, 6) AS {s}" for s in temporal.STATISTICS)


@query(f"SELECT user_id, event_type, {_ROUND9} FROM (SELECT user_id, event_type, {_STATS.format(v='value')} FROM events GROUP BY ALL)")
def temporal_stats(spark, sf):
    """O4.1"""
    out = temporal.statistics(_t(spark, sf, "events"), ["user_id", "event_type"], "value")
    return out.select("user_id", "event_type", *_r6(*temporal.STATISTICS))


@query(f"SELECT user_id, event_type, {_ROUND9} FROM (SELECT user_id, event_type, {_STATS.format(v='v')} FROM (SELECT *, CASE WHEN event_id % 7 <> 0 THEN value END AS v FROM events) GROUP BY ALL)")
def temporal_stats_nan_guard(spark, sf):
    """O4.4"""
    rows = _t(spark, sf, "events").withColumn("v", F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value")))
    return temporal.statistics(rows, ["user_id", "event_type"], "v").select("user_id", "event_type", *_r6(*temporal.STATISTICS))


@query("""SELECT user_id, """ + ", ".join(f"round(max(CASE WHEN event_type = '{t}' THEN {s} END), 6) AS {t}_{s}" for t in TYPES[:2] for s in ("min", "p50", "std")) + f""" FROM
  (SELECT user_id, event_type, {_STATS.format(v='value')} FROM events GROUP BY ALL) GROUP BY user_id""")
def temporal_image(spark, sf):
    """O4.2, O4.3: statistics as columns, feature by feature."""
    wide = temporal.statistics_wide(_t(spark, sf, "events"), ["user_id"], "event_type", TYPES[:2], "value")
    return wide.select("user_id", *(F.round(F.col(f"{s} {t}"), 6).alias(f"{t}_{s}") for t in TYPES[:2] for s in ("min", "p50", "std")))


@query("""SELECT user_id, (k * 5 + 1)::INT AS t, (s + (k * 5)::INT)::DATE AS date FROM
  (SELECT user_id, min(ts)::DATE AS s, max(ts)::DATE AS e FROM events GROUP BY user_id), generate_series(0, 10) AS g(k) WHERE s + (k * 5)::INT <= e""", dates=("date",))
def virtual_date_grid(spark, sf):
    """O5.4, O5.5"""
    bounds = _events(spark, sf).groupBy("user_id").agg(F.min("day").alias("start"), F.max("day").alias("end"))
    return temporal.grid(bounds, ["user_id"], "start", "end", 5)


_SERIES = """
WITH s AS (SELECT min(ts)::DATE AS start FROM events),
obs AS (SELECT user_id, event_type, (ts::DATE - start + 1)::INT AS t, (sum(cast(round(value * 100) AS BIGINT))::BIGINT // count(*))::BIGINT AS v FROM events, s {where} GROUP BY ALL),
keys AS (SELECT DISTINCT user_id, event_type FROM events),
n AS (SELECT user_id, event_type, count(*) AS n FROM obs GROUP BY ALL),
grid AS (SELECT user_id, event_type, g.t::INT AS t FROM keys, (SELECT unnest([1, 6, 11, 16, 21, 26]) AS t) g),
u AS (SELECT user_id, event_type, t, t AS ot, v, FALSE AS g FROM obs UNION ALL SELECT user_id, event_type, t, NULL, NULL, TRUE FROM grid),
w AS (SELECT *, last_value(ot IGNORE NULLS) OVER p AS t0, last_value(v IGNORE NULLS) OVER p AS v0, first_value(ot IGNORE NULLS) OVER f AS t1, first_value(v IGNORE NULLS) OVER f AS v1 FROM u
  WINDOW p AS (PARTITION BY user_id, event_type ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY user_id, event_type ORDER BY t RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT w.user_id, w.event_type, w.t, CASE WHEN coalesce(n, 0) < {least} THEN 0
  ELSE trunc(CASE WHEN t0 IS NULL THEN v1 WHEN t1 IS NULL OR t0 = t1 THEN v0 ELSE (v1 - v0)::DOUBLE / (t1 - t0) * (w.t - t0) + v0 END)::BIGINT END AS v
FROM w LEFT JOIN n ON n.user_id = w.user_id AND n.event_type = w.event_type WHERE w.g"""


def _virtual(spark, sf, least: int, only: Column | None):
    rows = _events(spark, sf)
    keys = ["user_id", "event_type"]
    start = F.broadcast(_start(rows).select("start"))  # one row
    rows = rows.crossJoin(start)
    kept = F.lit(True) if only is None else only
    cents = F.round(F.col("value") * 100).cast("bigint")
    daily = rows.groupBy(*keys, C.day_ordinal(F.col("day"), F.col("start")).alias("t")).agg(F.sum(F.when(kept, cents)).alias("c"), F.count_if(kept).alias("n"))
    daily = daily.withColumn("v", F.when(F.col("n") > 0, F.expr("c div n")))
    days = F.array(*(F.lit(d) for d in (1, 6, 11, 16, 21, 26)))
    out = temporal.interpolate(daily, keys, "t", "v", days, least)
    return out.select(*keys, "t", F.col("value").cast("bigint").alias("v"))


@query(_SERIES.format(where="WHERE value > 60", least=3))
def virtual_dates_10m(spark, sf):
    """O5.1"""
    return _virtual(spark, sf, 3, F.col("value") > 60)


@query(_SERIES.format(where="", least=13))
def virtual_dates_20m(spark, sf):
    """O5.2"""
    return _virtual(spark, sf, 13, None)


@query("""WITH k AS (SELECT DISTINCT user_id FROM events), g AS (SELECT user_id, t::INT AS t, FALSE AS b FROM k, generate_series(1, 26, 5) x(t) UNION ALL SELECT user_id, (user_id % 30 + 1)::INT, TRUE FROM k)
SELECT user_id, t, CASE WHEN NOT bool_or(b) THEN 'grid' WHEN count(*) > 1 THEN 'arop' ELSE 'base' END AS role FROM g GROUP BY user_id, t""")
def base_date_insert(spark, sf):
    """O5.6"""
    users = _t(spark, sf, "events").select("user_id").distinct()
    grid = users.select("user_id", F.explode(F.sequence(F.lit(1), F.lit(26), F.lit(5))).alias("t"))
    return temporal.with_base(grid, users.select("user_id", (F.col("user_id") % 30 + 1).cast("int").alias("t")), ["user_id"])


@query("SELECT event_id, event_type <> 'error' AND value > 0.05 AS valid FROM events")
def valid_mask(spark, sf):
    """O2.8: an error is a cloud, a value of at most 0.05 is nodata."""
    rows = _t(spark, sf, "events").select("event_id", F.col("event_type").alias("band"), F.when(F.col("value") > 0.05, F.col("value")).otherwise(-10000).alias("value"), F.when(F.col("event_type") == "error", 1).otherwise(0).alias("clm"))
    return temporal.valid_observations(rows, ["event_id"], -10000).select("event_id", "valid")


@query("SELECT user_id, day, NOT bool_or(event_type = 'error') AND NOT bool_or(event_type = 'click' AND value <= 20) AS valid FROM (SELECT *, ts::DATE AS day FROM events) GROUP BY user_id, day", dates=("day",))
def valid_mask_compat(spark, sf):
    """O2.8 as it was: nodata of the first band alone decides for a date."""
    rows = _events(spark, sf).select("user_id", "day", F.col("event_type").alias("band"), F.when(F.col("value") > 20, F.col("value")).otherwise(-10000).alias("value"), F.when(F.col("event_type") == "error", 1).otherwise(0).alias("clm"))
    out = temporal.valid_observations(rows, ["user_id", "day"], -10000, compat=True, first_band="click")
    return out.groupBy("user_id", "day").agg(F.bool_and("valid").alias("valid"))


@query("SELECT event_id, (ts::DATE - DATE '2024-01-01' + 1)::INT AS t, (DATE '2024-01-01' + (ts::DATE - DATE '2024-01-01')::INT)::DATE AS day FROM events", dates=("day",))
def day_ordinals(spark, sf):
    """O5.4 and back"""
    start = F.lit("2024-01-01").cast("date")
    rows = _events(spark, sf).withColumn("t", C.day_ordinal(F.col("day"), start))
    return rows.select("event_id", "t", C.date_of(F.col("t"), start).alias("day"))


# --- catalogue -------------------------------------------------------------------


@query("SELECT o_orderkey, o_orderdate::DATE AS day FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1995-03-01' AND DATE '1996-08-31'", dates=("day",))
def date_range_filter(spark, sf):
    """O2.6"""
    rows = _t(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return catalog.in_range(rows, "day", "1995-03-01", "1996-08-31")


@query("SELECT user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL HAVING count(DISTINCT event_type) = 5", dates=("day",))
def complete_dates(spark, sf):
    """O3.7"""
    return catalog.complete(_events(spark, sf), ["user_id", "day"], "event_type", TYPES)


@query("""WITH b AS (SELECT min(ts)::DATE AS s, max(ts)::DATE AS e FROM events), d AS (SELECT (s + k::INT)::DATE AS day FROM b, generate_series(0, 400) g(k) WHERE s + k::INT <= e)
SELECT user_id, day FROM (SELECT DISTINCT user_id FROM events), d EXCEPT SELECT user_id, ts::DATE FROM events""", dates=("day",))
def missing_dates(spark, sf):
    """O3.6"""
    rows = _events(spark, sf)
    days = rows.agg(F.sequence(F.min("day"), F.max("day")).alias("d"))
    expected = rows.select("user_id").distinct().crossJoin(F.broadcast(days)).select("user_id", F.explode("d").alias("day"))
    return catalog.missing(expected, rows, ["user_id", "day"])


@query("SELECT user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL HAVING count(*) >= 2", dates=("day",))
def duplicate_dates(spark, sf):
    """O4.10"""
    return catalog.duplicates(_events(spark, sf), ["user_id", "day"])


@query("""WITH e AS (SELECT user_id, ts::DATE AS day, event_id, value FROM events), p AS (SELECT user_id, day FROM e GROUP BY ALL HAVING count(*) = 2),
r AS (SELECT e.*, row_number() OVER (PARTITION BY user_id, day ORDER BY (value < 20)::INT, event_id) AS k FROM e JOIN p USING (user_id, day))
SELECT a.user_id, a.day, a.event_id AS base, CASE WHEN a.value < 20 AND b.value >= 20 THEN b.event_id ELSE a.event_id END AS taken_from, CASE WHEN a.value < 20 AND b.value >= 20 THEN b.value ELSE a.value END AS value
FROM r a JOIN r b ON a.user_id = b.user_id AND a.day = b.day AND a.k = 1 AND b.k = 2""", dates=("day",))
def duplicate_merge(spark, sf):
    """O4.9, O3.8: two events of a day are two acquisitions of one pixel."""
    rows = _events(spark, sf)
    twice = catalog.duplicates(rows, ["user_id", "day"]).where("n = 2").select("user_id", "day")
    out = merge.merge_duplicates(rows.join(twice, ["user_id", "day"]), ["user_id", "day"], "event_id", [], F.col("value") < 20, "value")
    return out.select("user_id", "day", "base", "taken_from", "value")


@query("""WITH p AS (SELECT user_id, event_type, ts::DATE AS day, event_id, value, value < 20 AS nd FROM events),
c AS (SELECT *, count(*) FILTER (WHERE nd) OVER (PARTITION BY user_id, day, event_id) AS k FROM p)
SELECT user_id, day, event_type, value, event_id AS taken_from FROM (SELECT *, row_number() OVER (PARTITION BY user_id, day, event_type ORDER BY nd::INT, k, event_id) AS rn FROM c) WHERE rn = 1""", dates=("day",))
def duplicate_merge_all(spark, sf):
    """O4.9 over any number of acquisitions, band by band."""
    out = merge.merge_duplicates(_events(spark, sf), ["user_id", "day"], "event_id", ["event_type"], F.col("value") < 20, "value")
    return out.select("user_id", "day", "event_type", "value", "taken_from")


@query("SELECT event_type, count(*) FILTER (WHERE value < 20) AS n_nodata, count(*) AS n FROM events GROUP BY event_type")
def nodata_count(spark, sf):
    """O2.14"""
    return merge.nodata_count(_t(spark, sf, "events"), ["event_type"], F.col("value") < 20)


@query("SELECT user_id, count(DISTINCT ts::DATE) AS n_days, count(DISTINCT event_type) AS n_bands, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS bands FROM events GROUP BY user_id")
def distinct_items(spark, sf):
    """O4.11"""
    return _events(spark, sf).groupBy("user_id").agg(F.count_distinct("day").alias("n_days"), F.count_distinct("event_type").alias("n_bands"), F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("bands"))


@query("""SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(na, 0) AS n_left, coalesce(nb, 0) AS n_right FROM (SELECT user_id, count(*) AS na FROM events WHERE value > 30 GROUP BY 1) a
FULL JOIN (SELECT user_id, count(*) AS nb FROM events WHERE value <= 30 GROUP BY 1) b ON a.user_id = b.user_id WHERE coalesce(na, 0) <> coalesce(nb, 0)""")
def cardinality_check(spark, sf):
    """O4.16"""
    rows = _t(spark, sf, "events")
    return catalog.same_count(rows.where("value > 30"), rows.where("value <= 30"), ["user_id"])


def _paths(spark: SparkSession, sf: str) -> DataFrame:
    """Raster paths made of nations: a folder for each nation and key, some without a .tif."""
    name = F.concat(F.lit("/in/S2A_2024"), F.lpad(F.col("n_regionkey") + 1, 2, "0"), F.lpad(F.col("n_nationkey") + 1, 2, "0"), F.lit("-1030_L2A_T"), F.col("n_nationkey") + 10, F.lit("ABC/"))
    files = F.array(*(F.lit(f"S2A_x_{b}.tif") for b in ("B2", "B8", "B8A", "CLM_R1")), F.lit("readme.txt"))
    rows = _t(spark, sf, "nation").select("n_nationkey", F.explode(files).alias("f"), name.alias("d")).where((F.col("n_nationkey") % 4 != 0) | (F.col("f") == "readme.txt"))
    return rows.select(F.concat("d", "f").alias("path"))


_PATHS = """(SELECT '/in/S2A_2024' || lpad((n_regionkey + 1)::VARCHAR, 2, '0') || lpad((n_nationkey + 1)::VARCHAR, 2, '0') || '-1030_L2A_T' || (n_nationkey + 10) || 'ABC' AS d, n_nationkey, n_regionkey, f
 FROM nation, (SELECT unnest(['S2A_x_B2.tif', 'S2A_x_B8.tif', 'S2A_x_B8A.tif', 'S2A_x_CLM_R1.tif', 'readme.txt']) AS f) WHERE n_nationkey % 4 <> 0 OR f = 'readme.txt')"""


@query(f"SELECT DISTINCT (n_nationkey + 10) || 'ABC' AS tile, make_date(2024, (n_regionkey + 1)::INT, (n_nationkey + 1)::INT) AS date, d[5:] AS scene_id, d AS path FROM {_PATHS} WHERE f LIKE '%.tif'", dates=("date",))
def scene_listing(spark, sf):
    """O1.8, O8.1"""
    return catalog.scene_list(_paths(spark, sf))


@query(f"SELECT d || '/' || f AS path, regexp_extract(f, '(B8|B2|CLM_R1)[.]tif$', 1) AS band FROM {_PATHS} WHERE f IN ('S2A_x_B2.tif', 'S2A_x_B8.tif', 'S2A_x_CLM_R1.tif')")
def band_paths(spark, sf):
    """O1.7, O1.9, O2.1: B8 and not B8A, and a cloud mask."""
    files = catalog.matching_files(_paths(spark, sf), ["_B", "CLM_R1"])
    return catalog.band_subset(files.withColumn("band", catalog.band_of(F.col("path"))), ("B2", "B8", "CLM_R1")).select("path", "band")


@query(f"SELECT (n_nationkey + 10) || 'ABC' AS tile, d || '/' || f AS path FROM {_PATHS} WHERE f = 'S2A_x_B8.tif'")
def exactly_one_file(spark, sf):
    """O1.10"""
    files = _paths(spark, sf).where(F.col("path").endswith(".tif")).withColumn("tile", F.regexp_extract("path", r"_T([^/]+)/", 1))
    return catalog.exactly_one(files, "tile", r"_B8\.tif$")


@query(f"SELECT (n_nationkey + 10) || 'ABC' AS tile, min(d || '/' || f) AS path FROM {_PATHS} WHERE f LIKE '%.tif' GROUP BY 1")
def first_match(spark, sf):
    """O6.4"""
    files = _paths(spark, sf).withColumn("tile", F.regexp_extract("path", r"_T([^/]+)/", 1))
    return catalog.first_match(files, "tile", r"\.tif$")


@query("SELECT name, row_number() OVER (ORDER BY p_size, num)::INT AS rank FROM (SELECT DISTINCT p_size, substr(p_brand, 7)::INT AS num, 'S' || p_size || '_' || substr(p_brand, 7) || '_x' AS name FROM part)")
def natural_sort(spark, sf):
    """O6.1: names with two numbers; some hundreds of names."""
    from pyspark.sql import Window

    names = _t(spark, sf, "part").select(F.concat(F.lit("S"), "p_size", F.lit("_"), F.substring("p_brand", 7, 9), F.lit("_x")).alias("name")).distinct()
    return names.select("name", F.row_number().over(Window.orderBy(*C.natural_key(F.col("name")))).alias("rank"))


@query("SELECT DISTINCT o_orderpriority, split_part(o_orderpriority, '-', 1) AS code, substr(o_orderpriority, 3) AS name FROM orders")
def name_parse(spark, sf):
    """O8.1"""
    p = F.col("o_orderpriority")
    return _t(spark, sf, "orders").select(p, F.get(F.split(p, "-"), 0).alias("code"), F.substring(p, 3, 50).alias("name")).distinct()


@query("SELECT n_nationkey, (30 + n_nationkey % 10)::VARCHAR AS zone FROM nation")
def utm_zone(spark, sf):
    """O8.2"""
    wkt = F.concat(F.lit('PROJCS["WGS 84 / UTM zone '), 30 + F.col("n_nationkey") % 10, F.lit('N",GEOGCS["WGS 84"]]'))
    return _t(spark, sf, "nation").select("n_nationkey", C.utm_zone(wkt).alias("zone"))


# --- pixels ----------------------------------------------------------------------

_CLIP = "least(greatest({0}, 0.0), 1.0)"


@query(f"SELECT l_orderkey, l_linenumber, round({_CLIP.format('l_extendedprice / 10000')}, 6) AS v FROM lineitem")
def normalize_clip(spark, sf):
    """O2.3"""
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(C.normalize(F.col("l_extendedprice")), 6).alias("v"))


@query(f"SELECT c_custkey, round({_CLIP.format('c_acctbal / 10000')}, 6) AS v FROM customer")
def normalize_clip_low(spark, sf):
    """O2.3"""
    return _t(spark, sf, "customer").select("c_custkey", F.round(C.normalize(F.col("c_acctbal")), 6).alias("v"))


def _ndi(a: str, b: str) -> str:
    return _CLIP.format(f"((CASE WHEN {a} + {b} <> 0 THEN ({a} - {b}) / ({a} + {b}) ELSE -1.0 END) + 1) / 2")


@query(f"SELECT l_orderkey, l_linenumber, round({_ndi('l_quantity', 'l_discount')}, 6) AS NDVI, round({_ndi('l_tax', 'l_quantity')}, 6) AS NDWI, round({_ndi('l_discount', 'l_tax')}, 6) AS guarded FROM lineitem")
def norm_diff_indices(spark, sf):
    """O2.4, O2.5"""
    rows = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("B8"), F.col("l_discount").alias("B4"), F.col("l_tax").alias("B3"))
    made = C.spectral_indices(("NDVI", "NDWI"))
    return rows.select("l_orderkey", "l_linenumber", *(F.round(v, 6).alias(k) for k, v in made.items()), F.round(C.normalized_difference(F.col("B4"), F.col("B3")), 6).alias("guarded"))


@query("SELECT user_id, " + ", ".join(f"round(sum(value) FILTER (WHERE event_type = '{t}'), 6) AS {t}" for t in TYPES) + " FROM events GROUP BY user_id")
def feature_stack(spark, sf):
    """O3.5"""
    return features.stack(_t(spark, sf, "events"), ["user_id"], "event_type", TYPES, "value").select("user_id", *_r6(*TYPES))


@query("SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS f0, (label - 1)::INT AS label FROM embeddings WHERE label > 0")
def ground_truth_filter(spark, sf):
    """O2.7, O3.4"""
    rows = _t(spark, sf, "embeddings")
    pixels = rows.select("vec_id", F.get("embedding", 0).cast("double").alias("f0"))
    return features.labelled(pixels, rows.select("vec_id", "label"), ["vec_id"], ["f0"]).select("vec_id", *_r6("f0"), "label")


@query(f"SELECT p_partkey, round({_CLIP.format('p_retailprice / 950')}, 6) AS v FROM part")
def aux_normalize(spark, sf):
    """O2.12"""
    return features.auxiliary(_t(spark, sf, "part").select("p_partkey", F.col("p_retailprice").alias("v")), "v", 950).select("p_partkey", *_r6("v"))


@query("SELECT event_id, CASE WHEN event_id % 11 IN (0, 1) THEN 65535.0 ELSE value END AS v, CASE WHEN event_id % 11 IN (0, 1) THEN 0 ELSE 1 END AS label FROM events")
def nan_fill(spark, sf):
    """O2.13"""
    v = F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).when(F.col("event_id") % 11 == 1, F.lit(float("inf"))).otherwise(F.col("value"))
    rows = features.for_classifier(_t(spark, sf, "events").select("event_id", v.alias("f")), ["f"])
    return rows.select("event_id", C.classifier_fill(F.col("f")).alias("v"), F.when(F.col("missing"), 0).otherwise(1).alias("label"))


_TENTHS = "trunc(c_acctbal * 10)::BIGINT"


@query(f"SELECT c_custkey, ((({_TENTHS} % 65536) + 65536) % 65536)::INT AS v FROM customer")
def wrap_unsigned(spark, sf):
    """unsigned 16-bit cells"""
    return _t(spark, sf, "customer").select("c_custkey", wrap_uint16((F.col("c_acctbal") * 10).cast("bigint")).alias("v"))


@query(f"SELECT c_custkey, (((({_TENTHS} + 32768) % 65536) + 65536) % 65536 - 32768)::INT AS v FROM customer")
def wrap_signed(spark, sf):
    """signed 16-bit cells"""
    return _t(spark, sf, "customer").select("c_custkey", wrap_int16((F.col("c_acctbal") * 10).cast("bigint")).alias("v"))


@query("WITH n AS (SELECT count(*) AS n FROM part) SELECT p_partkey, least(p_partkey // (n // 18), 17)::INT AS s18, least(p_partkey // (n // 45), 44)::INT AS s45 FROM part, n")
def row_strips(spark, sf):
    """O5.7"""
    rows = _t(spark, sf, "part")
    n = rows.count()
    y = F.col("p_partkey")
    return rows.select("p_partkey", C.row_strip(y, n, 18).alias("s18"), C.row_strip(y, n, 45).alias("s45"))


@query("SELECT least(p_partkey // (total // 18), 17)::INT AS strip, count(*) AS n, count(*) FILTER (WHERE p_size <= 10) AS n_flagged FROM part, (SELECT count(*) AS total FROM part) GROUP BY 1")
def sea_per_strip(spark, sf):
    """O4.15"""
    rows = _t(spark, sf, "part")
    rows = rows.select(C.row_strip(F.col("p_partkey"), rows.count(), 18).alias("strip"), (F.col("p_size") <= 10).alias("sea"))
    return spatial.strip_counts(rows, "strip", "sea")


def _raster(spark: SparkSession, sf: str) -> DataFrame:
    """tile, y, x, value of each embedding."""
    rows = _t(spark, sf, "embeddings").select(F.col("vec_id").alias("tile"), "label", F.posexplode("embedding").alias("i", "v"))
    return rows.select("tile", "label", F.floor(F.col("i") / 8).cast("int").alias("y"), (F.col("i") % 8).cast("int").alias("x"), F.col("v").cast("double").alias("value"))


_RASTER = "(SELECT vec_id AS tile, label, (i // 8)::INT AS y, (i % 8)::INT AS x, embedding[i + 1]::DOUBLE AS value FROM embeddings, generate_series(0, 63) g(i))"


@query(f"SELECT tile, t.y::INT AS y, u.x::INT AS x, round(value, 6) AS value FROM {_RASTER} r, generate_series(0, 15) t(y), generate_series(0, 15) u(x) WHERE r.y = t.y // 2 AND r.x = u.x // 2")
def nearest_upsample(spark, sf):
    """O5.8"""
    return spatial.resample_nearest(_raster(spark, sf).drop("label"), ["tile"], (8, 8), (16, 16)).select("tile", "y", "x", *_r6("value"))


@query(f"SELECT tile, t.y::INT AS y, u.x::INT AS x, round(value, 6) AS value FROM {_RASTER} r, generate_series(0, 4) t(y), generate_series(0, 2) u(x) WHERE r.y = t.y * 8 // 5 AND r.x = u.x * 8 // 3")
def nearest_downsample(spark, sf):
    """O5.8, to a grid that is not square"""
    return spatial.resample_nearest(_raster(spark, sf).drop("label"), ["tile"], (8, 8), (5, 3)).select("tile", "y", "x", *_r6("value"))


def _convolution(size: int, gain: int, source: str = _RASTER, column: str = "value") -> str:
    c, shift = size // 2, round(size / 2) - size // 2
    mirror = "CASE WHEN {0} < 0 THEN -1 - ({0}) WHEN {0} > 7 THEN 15 - ({0}) ELSE {0} END"
    return f"""SELECT o.tile, o.y, o.x, sum(CASE WHEN a.d = {-shift} AND b.d = {-shift} THEN {gain} ELSE -1 END * r.{column}) AS hpf
FROM {source} o, generate_series({-c}, {c}) a(d), generate_series({-c}, {c}) b(d), {source} r WHERE r.tile = o.tile AND r.y = {mirror.format('o.y + a.d')} AND r.x = {mirror.format('o.x + b.d')} GROUP BY ALL"""


@query(f"SELECT tile, y, x, round(hpf, 6) AS hpf FROM ({_convolution(5, 24)})")
def convolve_hpf5(spark, sf):
    """O5.9"""
    return spatial.high_pass(_raster(spark, sf), ["tile"], 8, 8, spatial.kernel_for(2.0)).select("tile", "y", "x", *_r6("hpf"))


@query(f"SELECT tile, y, x, round(hpf, 6) AS hpf FROM ({_convolution(7, 48)})")
def convolve_hpf7(spark, sf):
    """O5.9, O5.10: the centre is off by one"""
    return spatial.high_pass(_raster(spark, sf), ["tile"], 8, 8, spatial.kernel_for(3.0)).select("tile", "y", "x", *_r6("hpf"))


_WET = f"""(SELECT *, CASE WHEN water THEN 1.0 ELSE 0.0 END AS wet FROM (SELECT r.*, r.y * 8 + r.x = label AS water FROM {_RASTER} r WHERE tile % 2 = 0))"""
_MIRROR = "CASE WHEN {0} < 0 THEN -1 - ({0}) WHEN {0} > 7 THEN 15 - ({0}) ELSE {0} END"
_FUSION = f"""
WITH pan AS {_WET},
h AS ({_convolution(5, 24, 'pan')}),
wet AS (SELECT o.tile, o.y, o.x, sum(r.wet) AS w FROM pan o, generate_series(-2, 2) a(d), generate_series(-2, 2) b(d), pan r WHERE r.tile = o.tile AND r.y = {_MIRROR.format('o.y + a.d')} AND r.x = {_MIRROR.format('o.x + b.d')} GROUP BY ALL),
gain AS (SELECT tile, stddev_samp(hpf) AS sh FROM h JOIN wet USING (tile, y, x) WHERE w = 0 GROUP BY tile),
ms AS (SELECT tile - 1 AS tile, y, x, value FROM {_RASTER} WHERE tile % 2 = 1),
j AS (SELECT ms.*, h.hpf, pan.water FROM ms JOIN h USING (tile, y, x) JOIN pan USING (tile, y, x)),
low AS (SELECT tile, stddev_samp(value) AS sl, avg(value) AS ml FROM j WHERE NOT water GROUP BY tile),
f AS (SELECT j.*, sl, ml, value + hpf * (sl / sh * 0.25) AS f FROM j JOIN low USING (tile) JOIN gain USING (tile)),
lv AS (SELECT tile, avg(f) AS mf, stddev_pop(f) AS sf FROM f WHERE NOT water GROUP BY tile)
SELECT f.tile, y, x, round(f - mf * (sl / sf) + ml, 6) AS value FROM f JOIN lv USING (tile)"""


@query(_FUSION)
def hpf_fusion(spark, sf):
    """O5.11, O5.12: even vectors are panchromatic, the next ones a band."""
    rows = _raster(spark, sf)
    pan = rows.where("tile % 2 = 0").select("tile", "y", "x", "value", (F.col("y") * 8 + F.col("x") == F.col("label")).alias("water"))
    multi = rows.where("tile % 2 = 1").select((F.col("tile") - 1).alias("tile"), F.lit("B5").alias("band"), "y", "x", "value")
    return spatial.fuse(pan, multi, ["tile"], 8, 8).select("tile", "y", "x", *_r6("value"))


@query(f"SELECT tile, round(stddev_samp(value) FILTER (WHERE NOT m) / stddev_samp(value * value) FILTER (WHERE NOT m), 6) AS gain FROM (SELECT *, (x + y) % 3 = 0 AS m FROM {_RASTER}) GROUP BY tile")
def masked_gain(spark, sf):
    """O4.12"""
    rows = _raster(spark, sf).withColumn("high", F.col("value") * F.col("value")).withColumn("m", (F.col("x") + F.col("y")) % 3 == 0)
    return spatial.masked_gain(rows, ["tile"], "value", "high", "m").select("tile", *_r6("gain"))


_ZONES = """(SELECT p_partkey AS cell, p_size % 5 AS class, p_size AS prob, 0 AS rk FROM part WHERE p_partkey < 1300 UNION ALL SELECT p_partkey, (p_size + 1) % 5, (p_partkey % 50 + 1)::INT, 1 FROM part WHERE p_partkey >= 700)"""


@query(f"""WITH r AS (SELECT cell, class, prob, row_number() OVER (PARTITION BY cell ORDER BY prob DESC, rk) AS k FROM {_ZONES} WHERE class <> 0 AND prob > 0)
SELECT p_partkey AS cell, coalesce(class, 0)::INT AS class, coalesce(prob, 0)::INT AS prob FROM part LEFT JOIN r ON cell = p_partkey AND k = 1""")
def mosaic_max_prob(spark, sf):
    """O5.14"""
    part = _t(spark, sf, "part").withColumnRenamed("p_partkey", "cell")
    a = part.where("cell < 1300").select("cell", (F.col("p_size") % 5).alias("class"), F.col("p_size").alias("prob"), F.lit(0).alias("source_rank"))
    b = part.where("cell >= 700").select("cell", ((F.col("p_size") + 1) % 5).alias("class"), (F.col("cell") % 50 + 1).cast("int").alias("prob"), F.lit(1).alias("source_rank"))
    return spatial.mosaic(a.unionByName(b), ["cell"], part.select("cell"))


_WHOLE_ZONES = """(SELECT p_partkey AS cell, p_size % 5 AS class, p_size AS prob, 0 AS rk FROM part UNION ALL SELECT p_partkey, (p_size + 1) % 5, (p_partkey % 50 + 1)::INT, 1 FROM part)"""


@query(f"""WITH r AS (SELECT cell, class, prob, row_number() OVER (PARTITION BY cell ORDER BY prob DESC, rk) AS k FROM {_WHOLE_ZONES} WHERE class <> 0 AND prob > 0)
SELECT p_partkey AS cell, coalesce(class, 0)::INT AS class, coalesce(prob, 0)::INT AS prob FROM part LEFT JOIN r ON cell = p_partkey AND k = 1""")
def mosaic_overlap(spark, sf):
    """O5.14: two maps that both cover the whole table."""
    part = _t(spark, sf, "part").withColumnRenamed("p_partkey", "cell")
    a = part.select("cell", (F.col("p_size") % 5).alias("class"), F.col("p_size").alias("prob"), F.lit(0).alias("source_rank"))
    b = part.select("cell", ((F.col("p_size") + 1) % 5).alias("class"), (F.col("cell") % 50 + 1).cast("int").alias("prob"), F.lit(1).alias("source_rank"))
    return spatial.mosaic(a.unionByName(b), ["cell"], part.select("cell"))


_BOUNDS = "(SELECT n_regionkey AS zone, 300000.0 + n_nationkey * 1003 AS west, 4000000.0 + n_nationkey * 517 AS south, 300000.0 + n_nationkey * 1003 + 109805 AS east, 4000000.0 + n_nationkey * 517 + 109805 AS north FROM nation)"


def _bounds(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("n_nationkey")
    west, south = F.lit(300000.0) + k * 1003, F.lit(4000000.0) + k * 517
    return _t(spark, sf, "nation").select(F.col("n_regionkey").alias("zone"), "n_nationkey", west.alias("west"), south.alias("south"), (west + 109805).alias("east"), (south + 109805).alias("north"))


@query(f"SELECT west::DOUBLE AS west, south::DOUBLE AS south, east::DOUBLE AS east, north::DOUBLE AS north, round_even((east - west) / 10, 0)::INT AS columns, round_even((north - south) / 10, 0)::INT AS rows FROM (SELECT min(west) AS west, min(south) AS south, max(east) AS east, max(north) AS north FROM {_BOUNDS})")
def mosaic_extent(spark, sf):
    """O4.14"""
    return spatial.extent(_bounds(spark, sf))


@query(f"""WITH b AS (SELECT zone, max(west) AS west, max(south) AS south, min(east) AS east, min(north) AS north FROM {_BOUNDS} GROUP BY zone),
c AS (SELECT zone, min(west) AS west, min(south) AS south, min(east) AS east, min(north) AS north FROM {_BOUNDS} GROUP BY zone)
SELECT zone, greatest(b.west, c.west)::DOUBLE AS west, greatest(b.south, c.south)::DOUBLE AS south, least(b.east, c.east)::DOUBLE AS east, least(b.north, c.north)::DOUBLE AS north FROM b JOIN c USING (zone)
WHERE greatest(b.west, c.west) < least(b.east, c.east) AND greatest(b.south, c.south) < least(b.north, c.north)""")
def window_intersection(spark, sf):
    """O3.13, O2.16"""
    rows = _bounds(spark, sf).groupBy("zone")
    a = rows.agg(F.max("west").alias("west"), F.max("south").alias("south"), F.min("east").alias("east"), F.min("north").alias("north"))
    b = rows.agg(F.min("west").alias("west"), F.min("south").alias("south"), F.min("east").alias("east"), F.min("north").alias("north"))
    return spatial.intersection(a, b, "zone")


@query(f"SELECT n_nationkey, round_even((west - 300000) / 10, 0)::INT AS gx, round_even((4720000 - north) / 10, 0)::INT AS gy FROM (SELECT n_nationkey, 300000.0 + n_nationkey * 1003 AS west, 4000000.0 + n_nationkey * 517 + 109805 AS north FROM nation)")
def mosaic_placement(spark, sf):
    """O5.15"""
    rows = _bounds(spark, sf).select("n_nationkey", F.col("west").alias("px"), F.col("north").alias("py"))
    return spatial.placed(rows, 300000.0, 4720000.0).select("n_nationkey", "gx", "gy")


@query("""SELECT c_custkey, CASE WHEN c_nationkey % 2 = 1 OR c_acctbal IS NULL THEN 0 ELSE trunc(c_acctbal) END::INT AS virtual,
CASE WHEN c_nationkey % 2 = 1 THEN -10000 WHEN c_acctbal < 0 THEN 0 ELSE trunc(c_acctbal) END::INT AS sharpened, CASE WHEN c_nationkey % 2 = 0 THEN 0 ELSE 7 END AS label, CASE WHEN c_nationkey % 2 = 0 THEN 100 ELSE 55 END AS prob,
CASE WHEN c_nationkey % 2 = 0 THEN 0 ELSE 3 END AS label2, CASE WHEN c_nationkey % 2 = 0 THEN 100 ELSE 22 END AS prob2 FROM customer""")
def sea_fill(spark, sf):
    """O2.9, O2.10: sea is 1 in the first two masks, 0 in the third."""
    flag = F.col("c_nationkey") % 2
    v = F.col("c_acctbal").cast("int")
    rows = _t(spark, sf, "customer").select("c_custkey", merge.fill_virtual(v, merge.is_sea(flag)).alias("virtual"), merge.fill_sharpened(v, merge.is_sea(flag)).alias("sharpened"), flag.alias("flag"), F.lit(7).alias("label"), F.lit(55).alias("prob"), F.lit(3).alias("label2"), F.lit(22).alias("prob2"))
    return merge.fill_prediction(rows, merge.is_sea(F.col("flag"), 0)).drop("flag")


@query("SELECT c_custkey, CASE WHEN c_nationkey < 3 AND c_custkey % 3 = 0 THEN 1 ELSE 0 END AS flag FROM customer WHERE c_nationkey IN (0, 1, 2, 5, 6)")
def mask_fallback(spark, sf):
    """O2.11, O3.3: tiles 5 and 6 have no mask and may lack it."""
    rows = _t(spark, sf, "customer").select(F.col("c_nationkey").cast("string").alias("tile"), F.col("c_custkey").alias("y"), F.lit(0).alias("x"))
    tiles = rows.where("tile in ('0', '1', '2', '5', '6')")
    masks = rows.where("tile in ('0', '1', '2')").withColumn("flag", F.when(F.col("y") % 3 == 0, 1).otherwise(0))
    return catalog.with_fallback_mask(tiles, masks, ["5", "6"]).select(F.col("y").alias("c_custkey"), "flag")


@query("""SELECT c_custkey, CASE WHEN n_regionkey <> 3 AND c_acctbal < 0 THEN 1 ELSE 0 END AS flag FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def mask_fallback_region(spark, sf):
    """O2.11, O3.3 over all customers: the nations of one region have no mask and may lack it."""
    rows = _t(spark, sf, "customer").select(F.col("c_nationkey").cast("string").alias("tile"), F.col("c_custkey").alias("y"), F.lit(0).alias("x"), "c_acctbal")
    without = [str(r["n_nationkey"]) for r in _t(spark, sf, "nation").where("n_regionkey = 3").select("n_nationkey").collect()]
    masks = rows.where(~F.col("tile").isin(*without)).withColumn("flag", F.when(F.col("c_acctbal") < 0, 1).otherwise(0)).drop("c_acctbal")
    return catalog.with_fallback_mask(rows.drop("c_acctbal"), masks, without).select(F.col("y").alias("c_custkey"), "flag")


# --- maps and metrics ------------------------------------------------------------


@query("""WITH s AS (SELECT vec_id, i, embedding[i + 1]::DOUBLE AS p FROM embeddings, generate_series(0, 63) g(i)), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, i DESC) AS k FROM s)
SELECT a.vec_id, (a.i + 1)::INT AS label, floor(a.p * 100)::INT AS prob, (b.i + 1)::INT AS label2, floor(b.p * 100)::INT AS prob2 FROM r a JOIN r b ON a.vec_id = b.vec_id AND a.k = 1 AND b.k = 2""")
def top2_classes(spark, sf):
    """O6.2, O3.11"""
    scores = F.transform("embedding", lambda x: x.cast("double"))
    return _t(spark, sf, "embeddings").select("vec_id", *ml.best_two(scores))


@query("SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INT AS best FROM embeddings")
def argmax_class(spark, sf):
    """O6.3"""
    return _t(spark, sf, "embeddings").select("vec_id", ml.argmax(F.col("embedding")).alias("best"))


@query("SELECT n_nationkey, n_regionkey AS label, r_name AS abbreviation FROM nation JOIN region ON r_regionkey = n_regionkey")
def class_lookup(spark, sf):
    """O3.10"""
    names = _t(spark, sf, "region").select(F.col("r_regionkey").alias("code"), F.col("r_name").alias("abbreviation"))
    return metrics.named(_t(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("label")), names).select("n_nationkey", "label", "abbreviation")


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "embeddings").select(F.col("label").alias("gt"), (ml.argmax(F.col("embedding")) % 10).alias("pred"))


_PAIRS = "(SELECT label AS gt, ((list_position(embedding, list_max(embedding)) - 1) % 10)::INT AS pred FROM embeddings)"
_COUNTS = f"(SELECT gt, pred, count(*) AS n FROM {_PAIRS} GROUP BY gt, pred)"


@query(f"WITH c AS (SELECT gt AS c FROM {_PAIRS} UNION SELECT pred FROM {_PAIRS}) SELECT a.c AS gt, b.c AS pred, coalesce(n, 0)::BIGINT AS n FROM c a, c b LEFT JOIN {_COUNTS} k ON k.gt = a.c AND k.pred = b.c")
def confusion_counts(spark, sf):
    """O4.5, O7.8"""
    return metrics.filled(metrics.confusion(_pairs(spark, sf)))


@query(f"SELECT gt, pred, sum(n)::BIGINT AS n FROM {_COUNTS} GROUP BY CUBE (gt, pred)")
def confusion_margins(spark, sf):
    """O4.6"""
    return metrics.with_margins(metrics.confusion(_pairs(spark, sf)))


@query("SELECT gt, " + ", ".join(f"coalesce(sum(n) FILTER (WHERE pred = {k}), 0)::BIGINT AS \"{k}\"" for k in range(10)) + f" FROM {_COUNTS} GROUP BY gt")
def confusion_matrix(spark, sf):
    """D15, O1.17: the wide form"""
    return metrics.matrix(metrics.confusion(_pairs(spark, sf)), list(range(10)))


def _overall(pairs: str) -> str:
    return f"""WITH k AS (SELECT gt, pred, count(*) AS n FROM {pairs} GROUP BY ALL), r AS (SELECT gt AS c, sum(n) AS r FROM k GROUP BY 1), p AS (SELECT pred AS c, sum(n) AS p FROM k GROUP BY 1),
t AS (SELECT sum(n)::DOUBLE AS n, (sum(n) FILTER (WHERE gt = pred))::DOUBLE AS ok FROM k), e AS (SELECT sum(r::DOUBLE * p::DOUBLE) AS e FROM r JOIN p USING (c))
SELECT n::BIGINT AS n, round(ok / n, 6) AS accuracy, round((ok / n - e / (n * n)) / (1 - e / (n * n)), 6) AS kappa, round(1 - ok / n, 6) AS error_rate FROM t, e"""


@query(_overall(_PAIRS))
def kappa_oa(spark, sf):
    """O4.7, O4.13"""
    return metrics.overall(metrics.confusion(_pairs(spark, sf))).select("n", *_r6("accuracy", "kappa", "error_rate"))


@query(_overall("(SELECT quality AS gt, toxic AS pred FROM labels)"))
def error_rate(spark, sf):
    """O4.13"""
    counts = metrics.confusion(_t(spark, sf, "labels"), "quality", "toxic")
    return metrics.overall(counts).select("n", *_r6("accuracy", "kappa", "error_rate"))


_CLASSES = f"""WITH k AS {_COUNTS}, g AS (SELECT gt AS class, sum(n) AS support, sum(CASE WHEN gt = pred THEN n ELSE 0 END) AS hit FROM k GROUP BY 1), p AS (SELECT pred AS class, sum(n) AS said FROM k GROUP BY 1),
m AS (SELECT coalesce(g.class, p.class) AS class, coalesce(support, 0) AS support, coalesce(hit, 0)::DOUBLE AS hit, coalesce(said, 0) AS said FROM g FULL JOIN p ON g.class = p.class),
s AS (SELECT *, CASE WHEN said = 0 THEN 0.0 ELSE hit / said END AS u, CASE WHEN support = 0 THEN 0.0 ELSE hit / support END AS a FROM m)
SELECT class, {{ua}} AS ua, {{pa}} AS pa, {{f1}} AS f1, support::BIGINT AS support FROM s"""
_F1 = "round(CASE WHEN u + a > 0 THEN 2 * u * a / (u + a) ELSE 0.0 END, 6)"


@query(_CLASSES.format(ua="round(u * 100, 2)", pa="round(a * 100, 2)", f1=_F1))
def ua_pa(spark, sf):
    """O4.8, O4.17"""
    return metrics.per_class(metrics.confusion(_pairs(spark, sf)))


@query(_CLASSES.format(ua="CASE WHEN class < 8 THEN round(u * 100, 2) END", pa="CASE WHEN class < 8 THEN round(a * 100, 2) END", f1=f"CASE WHEN class < 8 THEN {_F1} END"))
def ua_pa_presence(spark, sf):
    """O4.8: training had classes 0 to 7 only"""
    seen = _t(spark, sf, "embeddings").where("label < 8").select(F.col("label").alias("class"))
    return metrics.per_class(metrics.confusion(_pairs(spark, sf)), seen)


@query("""WITH a AS (SELECT DISTINCT p_brand FROM part WHERE p_partkey % 40 = 0), b AS (SELECT DISTINCT p_brand FROM part WHERE p_partkey % 40 = 1)
SELECT p_brand, 'left' AS side FROM a WHERE p_brand NOT IN (SELECT p_brand FROM b) UNION ALL SELECT p_brand, 'right' FROM b WHERE p_brand NOT IN (SELECT p_brand FROM a)""")
def label_symdiff(spark, sf):
    """O7.2"""
    part = _t(spark, sf, "part")
    return metrics.label_sets(part.where("p_partkey % 40 = 0"), part.where("p_partkey % 40 = 1"), "p_brand")


@query("""WITH a AS (SELECT DISTINCT trunc(c_acctbal)::BIGINT AS amount FROM customer), b AS (SELECT DISTINCT trunc(o_totalprice)::BIGINT AS amount FROM orders)
SELECT amount, 'left' AS side FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.amount = a.amount) UNION ALL SELECT amount, 'right' FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.amount = b.amount)""")
def label_symdiff_tables(spark, sf):
    """O7.2 over two whole tables."""
    amounts = lambda table, column: _t(spark, sf, table).select(F.col(column).cast("long").alias("amount"))
    return metrics.label_sets(amounts("customer", "c_acctbal"), amounts("orders", "o_totalprice"), "amount")


@query("SELECT vec_id, label, CASE WHEN vec_id % 2 = 0 THEN 'train' ELSE 'test' END AS split FROM embeddings")
def vstack_union(spark, sf):
    """O7.1"""
    rows = _t(spark, sf, "embeddings").select("vec_id", "label")
    return features.vstack(rows.where("vec_id % 2 = 0").withColumn("split", F.lit("train")), rows.where("vec_id % 2 = 1").withColumn("split", F.lit("test")))


@query("""WITH f AS (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS i FROM (SELECT DISTINCT event_type FROM events)), s AS (SELECT unnest(['min', 'p10', 'p25', 'p50', 'p75', 'p90', 'max', 'mean', 'std']) AS s, unnest(range(9)) AS k)
SELECT (i * 9 + k)::INT AS position, s || ' ' || event_type AS description FROM f, s""")
def stat_descriptions(spark, sf):
    """O8.3"""
    return temporal.descriptions(_t(spark, sf, "events"), "event_type")


# --- plans -----------------------------------------------------------------------


@query("""SELECT y::INT AS year, make_date(y - 1, 10, 1) AS output_start, make_date(y, 10, 1) AS output_end, make_date(y - 1, 10, 1) - 31 AS input_start, make_date(y, 10, 1) + 31 AS input_end, 5 AS interval FROM (SELECT (2018 + r_regionkey)::BIGINT AS y FROM region)""", dates=("output_start", "output_end", "input_start", "input_end"))
def season_plan(spark, sf):
    """O8.10"""
    return jobs.season(_t(spark, sf, "region").select((2018 + F.col("r_regionkey")).cast("int").alias("year")), 10, 1)


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    tiles = _t(spark, sf, "nation").select(F.when(F.col("n_nationkey") == 7, "35SLD").otherwise(F.concat(F.col("n_nationkey") + 10, F.lit("SXY"))).alias("tile"))
    steps = _t(spark, sf, "region").where("r_regionkey < 4").select(F.get(F.array(*map(F.lit, jobs.STEPS)), F.col("r_regionkey")).alias("step"))
    return jobs.manifest(tiles, steps)


_TILES = "(SELECT CASE WHEN n_nationkey = 7 THEN '35SLD' ELSE (n_nationkey + 10) || 'SXY' END AS tile FROM nation)"
_STEPS = "(SELECT unnest(['virtual_dates', 'registration', 'sharpening', 'cleanup']) AS step)"


@query(f"SELECT step, tile, 'run ' || step || ' --tile ' || tile AS line FROM {_STEPS}, {_TILES} WHERE NOT (step = 'registration' AND tile = '35SLD')")
def job_manifest(spark, sf):
    """O8.11, O1.21, O2.15"""
    return jobs.script(_manifest(spark, sf))


@query(f"SELECT step, tile FROM {_STEPS}, {_TILES} WHERE NOT (step = 'registration' AND tile = '35SLD') AND step <> 'virtual_dates'")
def resume_pending(spark, sf):
    """O3.12"""
    todo = _manifest(spark, sf)
    return jobs.pending(todo, todo.where("step = 'virtual_dates'")).select("step", "tile")


@query("SELECT o_orderkey, (s // 3600) || ':' || lpad((s % 3600 // 60)::VARCHAR, 2, '0') || ':' || lpad((s % 60)::VARCHAR, 2, '0') AS hms FROM (SELECT o_orderkey, (o_orderkey * 37) % 86400 AS s FROM orders)")
def hms_format(spark, sf):
    """O8.6"""
    return _t(spark, sf, "orders").select("o_orderkey", C.hms(F.col("o_orderkey") * 37).alias("hms"))


@query(f"SELECT tile, 'map_' || tile || CASE WHEN tile = '35SLD' THEN '' ELSE '_AROP' END || '_5' AS name, 3 AS n_bands FROM {_TILES}")
def result_names(spark, sf):
    """O8.9, O8.4, O2.15"""
    tiles = _manifest(spark, sf).select("tile").distinct()
    return tiles.select("tile", C.joined_name(F.lit("map"), F.concat("tile", jobs.result_suffix(F.col("tile"))), F.lit("5")).alias("name"), F.size(C.comma_list(F.lit("B4, B8 ,B11"))).alias("n_bands"))


def _parameter_sql() -> str:
    """The parameter file of each nation, line by line."""
    name = "'T' || n_nationkey || '_20240101'"
    bands = ("B2", "B8A")
    files = lambda end: " || ' ' || ".join(f"{name} || '_{b}{end}'" for b in bands)
    side = {"FILE_TYPE": "'GEOTIFF'", "NSAMPLE": "'10980'", "NLINE": "'5490'", "PIXEL_SIZE": "'10'", "UPPER_LEFT_CORNER": "'300000, 4720000'", "UTM_ZONE": "(30 + n_regionkey)", "DATUM": "'12'"}
    values = {f"{p}_{k}": v for p in ("BASE", "WARP") for k, v in side.items()} | {
        "BASE_LANDSAT": "n_name || '_B4.tif'", "BASE_DATA_TYPE": "'2'", "BASE_SATELLITE": "'Sentinel2'", "WARP_SATELLITE": "'Sentinel2'", "WARP_NBANDS": "'2'", "WARP_LANDSAT_BAND": files(".tif"), "WARP_BAND_DATA_TYPE": "'2 2'", "WARP_BASE_MATCH_BAND": f"{name} || '_B4.tif'",
        "OUT_PIXEL_SIZE": "'10'", "RESAMPLE_METHOD": "'NN'", "OUT_EXTENT": "'BASE'", "OUT_LANDSAT_BAND": files("_AROP.tif"), "OUT_BASE_MATCH_BAND": f"{name} || '_B4_AROP.tif'", "OUT_BASE_POLY_ORDER": "'1'", "CP_LOG_FILE": "'cp_log.txt'", "CP_PARAMETERS_FILE": "'lndortho.cps_par.ini'",
    }
    lines = " || chr(10) || ".join(f"'{k} = ' || {values[k]}" for k in jobs.PARAMETER_KEYS)
    return f"SELECT n_nationkey::VARCHAR AS tile, 'PARAMETER_FILE' || chr(10) || {lines} || chr(10) || 'END' AS text FROM nation"


@query(_parameter_sql())
def registration_parameters(spark, sf):
    """O1.20, O7.3"""
    wkt = F.concat(F.lit("UTM zone "), 30 + F.col("n_regionkey"), F.lit("N"))
    image = F.struct(F.lit("GTiff").alias("driver"), F.lit(2).alias("dtype_code"), F.lit(10980).alias("columns"), F.lit(5490).alias("rows"), F.lit(10).alias("pixel"), F.lit(300000).alias("x0"), F.lit(4720000).alias("y0"), wkt.alias("crs"))
    tile = F.col("n_nationkey").cast("string")
    scenes = _t(spark, sf, "nation").select(tile.alias("tile"), F.lit("2024-01-01").cast("date").alias("date"), F.concat(F.lit("T"), tile, F.lit("_20240101")).alias("name"), F.concat("n_name", F.lit("_B4.tif")).alias("base_file"), image.alias("base"), image.alias("warp"))
    return jobs.registration_parameters(scenes, ["B2", "B8A"]).select("tile", "text")


# --- learning (no SQL) -----------------------------------------------------------


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    rows = _t(spark, sf, "embeddings")
    return rows.select("vec_id", "label", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"))


@query()
def rf_predict(spark, sf):
    """O7.4, O7.5: trained on even vectors"""
    rows = _vectors(spark, sf)
    model = ml.random_forest(trees=20, depth=8).fit(rows.where("vec_id % 2 = 0"))
    return model.transform(rows.where("vec_id % 2 = 1")).select("vec_id", "label", F.col("prediction").cast("int").alias("prediction"))


@query()
def rf_top2(spark, sf):
    """O7.5, O6.2, O7.6: a map with sea"""
    rows = _vectors(spark, sf).withColumn("sea", F.col("vec_id") % 9 == 0)
    model = ml.random_forest(trees=20, depth=8).fit(rows.where("vec_id % 2 = 0"))
    return ml.predict_map(model, rows, ["vec_id"], sea="sea")


@query()
def mlp_head(spark, sf):
    """O7.7"""
    rows = _vectors(spark, sf)
    model = ml.perceptron_head(64, 32, 10).fit(rows.where("vec_id % 2 = 0"))
    return model.transform(rows.where("vec_id % 2 = 1")).select("vec_id", "label", F.col("prediction").cast("int").alias("prediction"))


def _work(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and the executors share."""
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    return f"{(base or 'file:///tmp/skylattice-work').rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def _rasters(spark: SparkSession, sf: str) -> str:
    """A folder of rasters with two described bands: the values, and twice the values."""
    from .sources import geotiff

    folder = _work(spark, "geotiff")
    spark.dataSource.register(geotiff.GeoTiffSource)
    pixels = _raster(spark, sf).select(F.concat(F.lit("r"), "tile", F.lit(".tif")).alias("file"), F.explode(F.array(F.struct(F.lit("B4").alias("description"), F.col("value")), F.struct(F.lit("B8").alias("description"), (2 * F.col("value")).alias("value")))).alias("b"), "y", "x")
    geotiff.rasters(pixels.select("file", "b.*", "y", "x"), "file", 8, 8, ["B4", "B8"], "float64").write.format("geotiff").mode("append").save(folder)
    return folder


def _file() -> Column:
    return F.element_at(F.split("path", "/"), -1).alias("file")


_BANDS = f"(SELECT 'r' || tile || '.tif' AS file, tile, y, x, description, CASE WHEN description = 'B8' THEN 2 * value ELSE value END AS value FROM {_RASTER}, (VALUES ('B4'), ('B8')) b(description))"


@query(f"SELECT file, description, y, x, round(value, 6) AS value FROM {_BANDS}")
def geotiff_roundtrip(spark, sf):
    """O1.1, O1.11, O1.12: written with descriptions and read back"""
    from .sources import geotiff

    back = geotiff.read(spark, _rasters(spark, sf))
    return back.select(_file(), "description", "y", "x", *_r6("value"))


@query(f"SELECT file, y, x, round(value, 6) AS value FROM {_BANDS} WHERE description = 'B8'")
def geotiff_band(spark, sf):
    """O1.2: one band by its description"""
    from .sources import geotiff

    return geotiff.read(spark, _rasters(spark, sf), ["B8"]).select(_file(), "y", "x", *_r6("value"))


@query(f"SELECT DISTINCT file, 8 AS columns, 8 AS rows, 2 AS bands, 'float64' AS dtype, 'B4,B8' AS descriptions FROM {_BANDS}")
def geotiff_metadata(spark, sf):
    """O1.3"""
    from .sources import geotiff

    return geotiff.metadata(spark, _rasters(spark, sf)).select(_file(), "columns", "rows", "bands", "dtype", F.array_join("descriptions", ",").alias("descriptions"))


@query(f"SELECT file, description, y, x, round(value, 6) AS value FROM {_BANDS}")
def geotiff_strips(spark, sf):
    """O1.4: three strips of each file, by byte ranges"""
    from .sources import geotiff

    folder = _rasters(spark, sf)
    spark.dataSource.register(geotiff.GeoTiffSource)
    return spark.read.format("geotiff").option("strips", 3).load(folder).select(_file(), "description", "y", "x", *_r6("value"))


_UNIT = "least(greatest({0} / 1.5, 0.0), 1.0)"


@query(f"SELECT 'r' || tile || '.tif' AS file, y, x, round({_UNIT.format('value')}, 6) AS B4, 0.0::DOUBLE AS B11 FROM {_RASTER}")
def geotiff_normalized(spark, sf):
    """O1.5: a band that the rasters lack is 0"""
    from .sources import geotiff

    return geotiff.read_normalized(spark, _rasters(spark, sf), ["B4", "B11"], 1.5).select(_file(), "y", "x", *_r6("B4", "B11"))


@query(f"""SELECT file, y, x, least(y // 2, 2)::INT AS strip, round(B4, 6) AS B4, round(B8, 6) AS B8, round({_CLIP.format('(CASE WHEN B8 + B4 <> 0 THEN (B8 - B4) / (B8 + B4) ELSE -1.0 END + 1) / 2')}, 6) AS NDVI
FROM (SELECT 'r' || tile || '.tif' AS file, y, x, {_UNIT.format('value')} AS B4, {_UNIT.format('2 * value')} AS B8 FROM {_RASTER})""")
def geotiff_fused(spark, sf):
    """O1.6: strips, bands, scale and index in one read"""
    from .sources import geotiff

    return geotiff.read_normalized(spark, _rasters(spark, sf), ["B4", "B8"], 1.5, 3, ("NDVI",)).select(_file(), "y", "x", "strip", *_r6("B4", "B8", "NDVI"))


def _strip_maps(spark: SparkSession, sf: str) -> DataFrame:
    """Maps by strip, of which the strips of odd tiles are written a second time with other values."""
    from .plans import chains

    path = _work(spark, "strips")
    rows = _raster(spark, sf).select("tile", C.row_strip(F.col("y"), 8, 3).alias("strip"), "y", "x", "value")
    chains.write_strips(rows, path)
    chains.write_strips(rows.where("tile % 2 = 1 AND strip = 1").withColumn("value", F.col("value") + 1), path)
    return spark.read.parquet(path)


@query(f"SELECT tile::INT AS tile, least(y // 2, 2)::INT AS strip, y, x, round(value + CASE WHEN tile % 2 = 1 AND y // 2 = 1 THEN 1 ELSE 0 END, 6) AS value FROM {_RASTER}")
def strip_update(spark, sf):
    """O1.13: one strip is replaced, the others stay"""
    return _strip_maps(spark, sf).select(F.col("tile").cast("int").alias("tile"), F.col("strip").cast("int").alias("strip"), "y", "x", *_r6("value"))


@query(f"SELECT y AS gy, (x + 8 * (tile % 10))::INT AS gx, round(max(value + CASE WHEN tile % 2 = 1 AND y // 2 = 1 THEN 1 ELSE 0 END), 6) AS value FROM {_RASTER} GROUP BY ALL")
def strips_to_mosaic(spark, sf):
    """O1.14: strips of all tiles are put together on one grid"""
    cells = _strip_maps(spark, sf).select(F.col("y").alias("gy"), (F.col("x") + 8 * (F.col("tile") % 10)).cast("int").alias("gx"), "value")
    return cells.groupBy("gy", "gx").agg(F.round(F.max("value"), 6).alias("value"))


@query("SELECT round(embedding[1], 6) AS a, round(embedding[64], 6) AS b, count(*) AS n FROM embeddings GROUP BY ALL")
def npy_roundtrip(spark, sf):
    """O1.15"""
    from .sources import tables

    path = _work(spark, "npy")
    tables.write_npy(_t(spark, sf, "embeddings").select(F.col("embedding").cast("array<double>").alias("v")), "v", path)
    return tables.read_npy(spark, path).groupBy(F.round(F.get("values", 0), 6).alias("a"), F.round(F.get("values", 63), 6).alias("b")).agg(F.count("*").alias("n"))


@query("SELECT n_nationkey::INT AS code, n_name AS abbreviation FROM nation")
def nomenclature_sheet(spark, sf):
    """O1.16: a class list from a sheet; some dozens of rows."""
    import io
    import zipfile

    from .sources import geotiff, tables

    names = [r[0] for r in _t(spark, sf, "nation").orderBy("n_nationkey").select("n_name").collect()]
    cell = lambda at, v: f'<c r="{at}" t="inlineStr"><is><t>{v}</t></is></c>'
    rows = "".join(f'<row r="{k}">{cell(f"A{k}", k)}{cell(f"B{k}", v)}</row>' for k, v in enumerate(["Abbreviation", *names], 1))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{rows}</sheetData></worksheet>')
    folder = _work(spark, "sheet")
    where, root = geotiff._open(folder)
    where.create_dir(root, recursive=True)
    with where.open_output_stream(f"{root}/classes.xlsx") as out:
        out.write(data.getvalue())
    return tables.read_nomenclature(spark, f"{folder}/classes.xlsx")


@query("SELECT n_regionkey::INT AS gt, " + ", ".join(f"count(*) FILTER (n_nationkey % 5 = {k}) AS c{k}" for k in range(5)) + " FROM nation GROUP BY 1")
def matrix_sink(spark, sf):
    """O1.17: a confusion matrix as a file"""
    from .sources import tables

    pairs = _t(spark, sf, "nation").select(F.col("n_regionkey").alias("gt"), (F.col("n_nationkey") % 5).alias("pred"))
    path = _work(spark, "matrix")
    tables.write_matrix(metrics.matrix(metrics.confusion(pairs), list(range(5))), path)
    return spark.read.option("header", True).csv(path).select(F.col("gt").cast("int").alias("gt"), *(F.col(str(k)).cast("long").alias(f"c{k}") for k in range(5)))


@query("SELECT vec_id, true AS same FROM embeddings")
def model_roundtrip(spark, sf):
    """O1.18: a forest that was saved and loaded predicts the same"""
    rows = _vectors(spark, sf)
    model = ml.random_forest(trees=5, depth=5).fit(rows)
    path = _work(spark, "model")
    ml.save(model, path)
    predicted = lambda m, name: m.transform(rows).select("vec_id", F.col("prediction").alias(name))
    both = predicted(ml.released(model), "a").join(predicted(ml.load_forest(path), "b"), "vec_id")
    return both.select("vec_id", (F.col("a") == F.col("b")).alias("same"))


@query("SELECT r_name AS class, n_nationkey::VARCHAR || '.txt' AS file, n_name AS content FROM nation JOIN region ON n_regionkey = r_regionkey")
def image_folders(spark, sf):
    """O1.19: classes are folders, whatever the files hold"""
    from .sources import geotiff, tables

    rows = _t(spark, sf, "nation").join(_t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name").collect()
    folder = _work(spark, "images")
    where, root = geotiff._open(folder)
    for r in rows:
        where.create_dir(f"{root}/{r['r_name']}", recursive=True)
        with where.open_output_stream(f"{root}/{r['r_name']}/{r['n_nationkey']}.txt") as out:
            out.write(r["n_name"].encode())
    return tables.image_folder(spark, folder).select("class", _file(), F.decode("content", "UTF-8").alias("content"))


@query("SELECT n_name || '=' || n_nationkey AS value FROM nation")
def text_sink(spark, sf):
    """O1.21"""
    from .sources import tables

    path = _work(spark, "text")
    tables.write_text(_t(spark, sf, "nation").select(F.concat("n_name", F.lit("="), F.col("n_nationkey").cast("string")).alias("line")), "line", path)
    return spark.read.text(path)


@query("SELECT * FROM (VALUES " + ", ".join(f"('{p}', '{m}')" for p, m in spatial.PAIRS) + ") t(pan, band)")
def band_pairs(spark, sf):
    """O5.12"""
    return spark.createDataFrame(list(spatial.PAIRS), "pan string, band string")


@query("SELECT n_nationkey, unnest([n_name, n_regionkey::VARCHAR, 'x']) AS item FROM nation")
def comma_lists(spark, sf):
    """O8.4"""
    text = F.concat_ws(" , ", "n_name", F.col("n_regionkey").cast("string"), F.lit("x "))
    return _t(spark, sf, "nation").select("n_nationkey", F.explode(C.comma_list(text)).alias("item"))


@query("SELECT * FROM (VALUES (false, false, 25::BIGINT), (true, true, 0::BIGINT)) t(confirmed, deleted, rows_left)")
def clean_up_confirmed(spark, sf):
    """O8.12: only a confirmed clean-up deletes"""
    path = _work(spark, "cleanup")
    _t(spark, sf, "nation").write.parquet(path)
    out = []
    for confirmed in (False, True):
        deleted = jobs.clean_up(spark, path, confirmed)
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        left = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
        out.append((confirmed, deleted, spark.read.parquet(path).count() if left else 0))
    return spark.createDataFrame(out, "confirmed boolean, deleted boolean, rows_left long")


@query(f"SELECT tile, (i // 6)::INT AS y, (i % 6)::INT AS x, true AS same FROM (SELECT DISTINCT tile FROM {_RASTER}), generate_series(0, 35) g(i)")
def registration_shift(spark, sf):
    """O7.3: images moved by (1, 2) come back onto their base; the border that moved out is lost"""
    import numpy as np
    import pyarrow as pa

    def image(tile: int) -> np.ndarray:
        return np.random.default_rng(tile).normal(size=(8, 8))

    def make(batches):
        for batch in batches:
            tiles = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_pydict({
                "tile": batch.column(0), "date": pa.nulls(len(tiles), pa.date32()), "band": ["B2"] * len(tiles), "h": pa.array([8] * len(tiles), pa.int32()), "w": pa.array([8] * len(tiles), pa.int32()),
                "data": pa.array([np.roll(image(t), (1, 2), (0, 1)).tobytes() for t in tiles], pa.binary()), "base": pa.array([image(t).tobytes() for t in tiles], pa.binary()),
            })

    made = _raster(spark, sf).select("tile").distinct().mapInArrow(make, "tile long, date date, band string, h int, w int, data binary, base binary")
    moved = jobs.register_to(made.drop("base"), made.select("tile", "h", "w", F.col("base").alias("data")))

    def compare(batches):
        for batch in batches:
            for tile, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                same = np.frombuffer(data.as_buffer(), np.float64).reshape(8, 8)[:6, :6] == image(tile)[:6, :6]
                y, x = np.divmod(np.arange(36, dtype=np.int32), np.int32(6))
                yield pa.RecordBatch.from_pydict({"tile": pa.array([tile] * 36), "y": pa.array(y), "x": pa.array(x), "same": pa.array(same.ravel())})

    return moved.select("tile", "data").mapInArrow(compare, "tile long, y int, x int, same boolean")
