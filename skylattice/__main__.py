"""Command line: the steps of the chains over Parquet tables.

    python -m skylattice virtual-dates --pixels P --clouds C --sea S --start 2023-08-31 --output-start 2023-10-01 --output-end 2024-10-01 --out O
    python -m skylattice sharpen --cube P --water W --sea S --rows 10980 --columns 10980 --out O
    python -m skylattice features --cube P --bands B3,B4,B8,B11 --out O
    python -m skylattice train --table P --labels L --model M --out O
    python -m skylattice predict --table P --model M --sea S --out O
    python -m skylattice mosaic --maps P1,P2 --out O
    python -m skylattice query --name temporal_stats --tables DIR --out O
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("tile", "y", "x")


def items(text: str) -> list[str]:
    """A comma list."""
    return [x.strip() for x in text.split(",") if x.strip()]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="skylattice")
    steps = top.add_subparsers(dest="step", required=True)

    def step(name: str, *required: str, **optional) -> None:
        p = steps.add_parser(name)
        for r in required:
            p.add_argument(f"--{r}", required=True, type=int if r in ("rows", "columns") else str)
        for o, default in optional.items():
            p.add_argument(f"--{o.replace('_', '-')}", default=default, type=items if isinstance(default, list) else type(default))
        p.add_argument("--out", required=True)

    step("virtual-dates", "pixels", "clouds", "sea", "start", "output-start", "output-end", interval=5, bands=["B2", "B3", "B4", "B8"], min_obs=0)
    step("sharpen", "cube", "water", "sea", "rows", "columns", ratio=2.0)
    step("features", "cube", bands=["B3", "B4", "B8", "B11"], indices=["NDVI", "NDWI", "NDBI"])
    step("train", "table", "labels", "model", trees=100, depth=30)
    step("predict", "table", "model", "sea")
    step("mosaic", "maps")
    step("query", "name", "tables")
    return top


def columns_of(table: DataFrame) -> list[str]:
    return [c for c in table.columns if c not in (*KEYS, "split", "label")]


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The result of a step, not yet written."""
    from .operators import ml
    from .plans import chains

    read = spark.read.parquet
    if args.step == "virtual-dates":
        return chains.virtual_dates(read(args.pixels), read(args.clouds), read(args.sea), args.start, args.output_start, args.output_end, args.interval, tuple(args.bands), args.min_obs or None)
    if args.step == "sharpen":
        return chains.sharpened(read(args.cube), read(args.water), read(args.sea), args.rows, args.columns, args.ratio)
    if args.step == "features":
        return chains.temporal_features(read(args.cube), args.bands, tuple(args.indices))
    if args.step == "train":
        table = read(args.table)
        model, overall, classes = chains.train_and_evaluate(table, read(args.labels), columns_of(table), ml.random_forest(args.trees, args.depth))
        ml.save(model, args.model)
        return classes.crossJoin(F.broadcast(overall))  # one row of overall metrics beside each class
    if args.step == "predict":
        table = read(args.table)
        return chains.class_map(ml.load_forest(args.model), table, columns_of(table), read(args.sea))
    if args.step == "mosaic":
        maps = [read(p).withColumn("_rank", F.lit(k)) for k, p in enumerate(items(args.maps))]
        union = maps[0]
        for m in maps[1:]:
            union = union.unionByName(m)
        return chains.mosaic(union, F.col("_rank"))
    from .queries import QUERIES

    return QUERIES[args.name](spark, args.tables)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"skylattice {args.step}").getOrCreate()
    start = time.time()
    run(spark, args).write.mode("overwrite").parquet(args.out)
    took = int(time.time() - start) % 86400
    print(f"{args.step}: {took // 3600}:{took // 60 % 60:02d}:{took % 60:02d}")


if __name__ == "__main__":
    main()
