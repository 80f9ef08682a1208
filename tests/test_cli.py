import pytest

from skylattice.__main__ import main, parser, run


def test_required_and_lists():
    with pytest.raises(SystemExit):
        parser().parse_args(["sharpen", "--cube", "a"])
    args = parser().parse_args(["features", "--cube", "a", "--bands", "B3, B4 ,B8", "--out", "o"])
    assert args.bands == ["B3", "B4", "B8"] and args.indices == ["NDVI", "NDWI", "NDBI"]


def test_features_train_predict_mosaic(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    cells = [(y, x) for y in range(6) for x in range(6)]
    spark.createDataFrame([("T", t, b, y, x, 500 * (1 + y % 3) + 10 * t) for t in (1, 6) for b in ("B3", "B4", "B8", "B11") for y, x in cells], "tile string, t int, band string, y int, x int, value int").write.parquet(p("cube"))
    spark.createDataFrame([("T", "train" if x < 4 else "test", y, x, 1 + y % 3) for y, x in cells], "tile string, split string, y int, x int, label int").write.parquet(p("labels"))
    spark.createDataFrame([("T", y, x, int(y > 0)) for y, x in cells], "tile string, y int, x int, flag int").write.parquet(p("sea"))
    main(["features", "--cube", p("cube"), "--out", p("table")])
    main(["train", "--table", p("table"), "--labels", p("labels"), "--model", p("model"), "--trees", "5", "--depth", "3", "--out", p("metrics")])
    assert spark.read.parquet(p("metrics")).head()["accuracy"] == 1.0
    main(["predict", "--table", p("table"), "--model", p("model"), "--sea", p("sea"), "--out", p("map")])
    rows = spark.read.parquet(p("map"))
    assert rows.count() == 36 and rows.where("y = 0").head()["prob"] == 100
    rows.selectExpr("*", "300000.0 + x * 10 as px", "4720000.0 - y * 10 as py").write.parquet(p("placed"))
    args = parser().parse_args(["mosaic", "--maps", f"{p('placed')},{p('placed')}", "--out", p("mosaic")])
    assert run(spark, args).count() == 30
