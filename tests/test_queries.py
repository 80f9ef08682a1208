"""Every registered query of the engine against DuckDB on the smallest tables."""

import math
import os

import pytest

from skylattice.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events embeddings labels".split()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(names, values):
    def text(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return ""
        return f"{v:.6f}" if isinstance(v, float) else str(v)

    order = sorted(range(len(names)), key=lambda k: names[k])
    return [names[k] for k in order], sorted(tuple(text(v[k]) for k in order) for v in values)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name in ORACLE_SQL:
        res = duck.sql(ORACLE_SQL[name])
        assert got == rows(res.columns, res.fetchall())
    else:
        assert got[1]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
def test_mosaic_of_many_strips(spark, duck):
    """The strips of all tiles go into a bounded number of folders, and the mosaic is that of the SQL."""
    from pathlib import Path

    from skylattice.plans import chains

    base = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(base.glob("strips-*"))
    df = QUERIES["strips_to_mosaic"](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    (made,) = set(base.glob("strips-*")) - before
    assert sum(p.is_dir() for p in made.rglob("*")) <= chains.STRIP_FOLDERS
    res = duck.sql(ORACLE_SQL["strips_to_mosaic"])
    assert got == rows(res.columns, res.fetchall()) and len(got[1]) == 640
