"""Feature arrays, nomenclatures, matrices, image folders and text files."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def read_npy(spark: SparkSession, path: str) -> DataFrame:
    """path, row, values of the .npy matrices under path (a vector has one value a row)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                array = np.load(io.BytesIO(data.as_buffer().to_pybytes()), allow_pickle=False)
                array = array.reshape(len(array), -1)
                for a in range(0, len(array), 50_000):
                    part = array[a : a + 50_000].astype(np.float64)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * part.shape[1], pa.int32()), pa.array(part.ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(part)), pa.array(np.arange(a, a + len(part))), lists], names=["path", "row", "values"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npy").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(scan, "path string, row long, values array<double>")


def write_npy(rows: DataFrame, column: str, path: str) -> None:
    """A column of equally long arrays as .npy matrices under path, one for each partition that has rows."""
    from .geotiff import _open

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = [np.array(batch.column(0).to_pylist()) for batch in batches if batch.num_rows]
        if held:
            where, root = _open(path)
            where.create_dir(root, recursive=True)
            data = io.BytesIO()
            np.save(data, np.concatenate(held))
            with where.open_output_stream(f"{root}/part-{TaskContext.get().partitionId():06d}.npy") as out:
                out.write(data.getvalue())
            yield pa.RecordBatch.from_pydict({"rows": pa.array([sum(map(len, held))])})

    rows.select(column).mapInArrow(put, "rows long").agg(F.sum("rows")).collect()


def write_features(rows: DataFrame, path: str) -> None:
    """Feature tables: Parquet by tile and split."""
    rows.write.mode("overwrite").partitionBy("tile", "split").parquet(path)


def sheet_rows(data: bytes, sheet: str = "sheet1") -> list[list[str | None]]:
    """Cells of a worksheet of an .xlsx file, as text."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        root = ElementTree.fromstring(z.read(f"xl/worksheets/{sheet}.xml"))
    out = []
    for row in root.iter(f"{_MAIN}row"):
        cells: dict[int, str | None] = {}
        for k, c in enumerate(row.iter(f"{_MAIN}c")):
            letters = re.match(r"[A-Z]+", c.get("r", ""))
            at = k
            if letters:
                at = 0
                for ch in letters[0]:
                    at = at * 26 + ord(ch) - 64
                at -= 1
            v = c.find(f"{_MAIN}v")
            inline = c.find(f"{_MAIN}is")
            text = "".join(t.text or "" for t in inline.iter(f"{_MAIN}t")) if inline is not None else None if v is None else v.text
            cells[at] = shared[int(text)] if c.get("t") == "s" and text is not None else text
        out.append([cells.get(i) for i in range(max(cells, default=-1) + 1)])
    return out


def read_nomenclature(spark: SparkSession, path: str, header: str = "Abbreviation") -> DataFrame:
    """code (from 0), abbreviation of a class list, .csv or .xlsx: a dimension of some dozens of rows."""
    if path.endswith(".xlsx"):
        data = spark.read.format("binaryFile").load(path).select("content").head()[0]
        rows = sheet_rows(bytes(data))
        at = rows[0].index(header)
        names = [r[at] for r in rows[1:] if at < len(r) and r[at] is not None]
        return spark.createDataFrame(list(enumerate(names)), "code int, abbreviation string")
    names = spark.read.option("header", True).csv(path).select(header).collect()
    return spark.createDataFrame([(k, r[0]) for k, r in enumerate(names)], "code int, abbreviation string")


def write_matrix(matrix: DataFrame, path: str) -> None:
    """A confusion matrix as one CSV file (at most classes squared cells)."""
    matrix.orderBy(matrix.columns[0]).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def image_folder(spark: SparkSession, path: str, validation: float = 0.2, seed: int = 1) -> DataFrame:
    """path, class (name of the folder), split, content of the images under path; the split depends on the path alone."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    share = F.pmod(F.xxhash64("path", F.lit(seed)), F.lit(10_000)) / 10_000
    return rows.select("path", F.element_at(F.split("path", "/"), -2).alias("class"), F.when(share < validation, "validation").otherwise("train").alias("split"), "content")


def write_text(rows: DataFrame, column: str, path: str) -> None:
    rows.select(column).write.mode("append").text(path)
