"""spark-submit entry points: inspect, identifiers, version."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import __version__
from .functions.values import salt_from_environment
from .operators.actions import Engine
from .operators.predicates import findings
from .operators.recipe import Recipe
from .operators.selectors import Field
from .sources.files import flagged_report


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="veilframe")
    sub = top.add_subparsers(dest="command", required=True)
    sub.add_parser("version")
    look = sub.add_parser("inspect", help="report the records that a recipe's filters flag")
    put = sub.add_parser("identifiers", help="apply a recipe's header actions")
    for p in (look, put):
        p.add_argument("--recipe", required=True)
        p.add_argument("--input", required=True, help="parquet of wide records")
        p.add_argument("--output", required=True)
    put.add_argument("--ids", help="JSON lines of replacement ids by src_path")
    put.add_argument("--overwrite", action="store_true")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "version":
        print(__version__)
        return 0
    spark = SparkSession.builder.appName("veilframe").getOrCreate()
    records, recipe = spark.read.parquet(args.input), Recipe.load(args.recipe)
    if args.command == "inspect":
        resolve = lambda name: F.col(name) if name in records.columns else None
        found = records.select("src_path", findings(recipe, resolve).alias("findings"))
        flagged_report(found, args.output)
        print(json.dumps({r["flagged"]: r["count"] for r in found.groupBy((F.size("findings") > 0).cast("string").alias("flagged")).count().collect()}))
        return 0
    names, variables = list(records.columns), {}
    if args.ids:
        ids = spark.read.json(args.ids)
        variables = {c: c for c in ids.columns if c != "src_path"}
        records = records.join(ids, "src_path", "left")
    salted = any("deid_func:" in (a.value or "") for a in recipe.header)
    engine = Engine(recipe, salt=salt_from_environment() if salted else "", variables=variables)
    out = engine.wide(records, [Field(c) for c in names if c != "src_path"]).drop(*variables)
    out.write.mode("overwrite" if args.overwrite else "errorifexists").parquet(args.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
