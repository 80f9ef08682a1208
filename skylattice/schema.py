"""Explicit schemas of the data model, sentinels and fixed-width wrap-around.

A raster is rows of pixels.  ``pixel_id = y * cols + x`` keys what other tools
keep aligned by position.  Missing values are NULL inside the engine; the
sentinels below occur only at sources and sinks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the domain: sentinels, reflectance scale, bands by resolution.
NODATA = -10000
CLASSIFIER_FILL = 65535
REFLECTANCE = 10000
BANDS_10M = ("B2", "B3", "B4", "B8")
BANDS_20M = ("B5", "B6", "B7", "B8A", "B11", "B12")
MASKS = ("CLM_R1", "CLM_R2")


# Schemas are DDL text, which readers and createDataFrame take as it is.
GEOREF = "x0 double, dx double, rx double, y0 double, ry double, dy double, crs string, driver string"
PIXELS = "tile string, date date, band string, y int, x int, value int"
BLOCKS = "tile string, date date, band string, by int, bx int, h int, w int, data binary"
MASK = "tile string, y int, x int, flag int"
SCENES = "tile string, date date, scene_id string, path string"
SCENE_FILES = "path string, tile string, date date, band string, is_mask boolean, resolution string"
OBSERVATIONS = "tile string, pixel_id bigint, band string, t int, valid boolean, value int"
FEATURES = "tile string, pixel_id bigint, feature string, t int, value double"
LABELS = "tile string, split string, y int, x int, label int"
NOMENCLATURE = "code int, abbreviation string"
CLASS_MAP = "tile string, y int, x int, label int, prob int, label2 int, prob2 int"
CONFUSION = "gt int, pred int, n bigint"
MANIFEST = "step string, tile string, args map<string,string>"

#: Sample types of rasters and the Spark types that hold them (Spark has no unsigned ones).
SAMPLE_TYPES = {"uint8": "smallint", "uint16": "int", "int16": "smallint", "uint32": "bigint", "int32": "int", "float32": "float", "float64": "double"}


def null_if(value: Column, sentinel: int = NODATA) -> Column:
    """Sentinel to NULL, at a source."""
    return F.when(value != sentinel, value)


def or_sentinel(value: Column, sentinel: int = NODATA) -> Column:
    """NULL to sentinel, at a sink."""
    return F.coalesce(value, F.lit(sentinel))


def wrap_uint16(value: Column) -> Column:
    """What an unsigned 16-bit cell keeps of an integer; -10000 becomes 55536."""
    return F.pmod(value.cast("bigint"), F.lit(65536)).cast("int")


def wrap_int16(value: Column) -> Column:
    """What a signed 16-bit cell keeps of an integer; 40000 becomes -25536."""
    return (F.pmod(value.cast("bigint") + 32768, F.lit(65536)) - 32768).cast("int")
