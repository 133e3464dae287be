"""Command line: list the catalogue, run one query, a block, or all of them.

    spark-submit -m bancalyt list
    spark-submit -m bancalyt run b2_top3_province --testdata /data/sf1 --out /out/b2
    spark-submit -m bancalyt run-block charts --parquet /warehouse/bank --out /out/charts
    spark-submit -m bancalyt run-all --catalog bank --out /out/all --format json

Results are written by the executors (one directory per query); nothing is
collected to the driver except with ``--show N``, which prints N rows.
"""

from __future__ import annotations

import argparse
import ast
import sys

from pyspark.sql import DataFrame, SparkSession

from bancalyt.plans.registry import BLOCKS, REGISTRY, run, run_all, run_block
from bancalyt.session import configure
from bancalyt.sources import from_testdata, load_catalog, load_jdbc, load_parquet, write_report
from bancalyt.sources.tables import BankTables


def _source(spark: SparkSession, args) -> BankTables:
    if args.testdata:
        return from_testdata(spark, args.testdata)
    if args.parquet:
        return load_parquet(spark, args.parquet)
    if args.catalog:
        return load_catalog(spark, args.catalog)
    if args.jdbc:
        return load_jdbc(spark, args.jdbc, dict(_pairs(args.property)))
    raise SystemExit("give one of --testdata, --parquet, --catalog, --jdbc")


def _pairs(items: list[str]) -> list[tuple[str, str]]:
    pairs = [tuple(item.split("=", 1)) for item in items]
    if any(len(p) != 2 for p in pairs):
        raise SystemExit("give properties and parameters as NAME=VALUE")
    return pairs


def _params(items: list[str]) -> dict:
    """NAME=VALUE: numbers and None as such, anything else as text."""
    out = {}
    for name, value in _pairs(items):
        try:
            out[name] = ast.literal_eval(value)
        except (ValueError, SyntaxError):
            out[name] = value
    return out


def _emit(key: str, df: DataFrame, args) -> None:
    """Write and show a result; what was written is shown from there, so that
    the query runs once."""
    if args.out:
        target = args.out if args.command == "run" else f"{args.out}/{key}"
        if args.format == "json":
            d = REGISTRY[key]
            write_report(df, target, {"id": key, "title": d.title, "block": d.block, "tables": list(d.tables)}, args.mode)
        else:
            df.write.mode(args.mode).format(args.format).save(target)
        if args.show:
            df = df.sparkSession.read.format(args.format).schema(df.schema).load(target)
    if args.show:
        df.show(args.show, truncate=False)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="bancalyt")
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("list", help="print the catalogue (key, block, title)")
    for name in ("run", "run-block", "run-all"):
        p = sub.add_parser(name)
        if name == "run":
            p.add_argument("key", choices=sorted(REGISTRY))
        if name == "run-block":
            p.add_argument("block", choices=list(BLOCKS))
        src = p.add_mutually_exclusive_group(required=True)
        src.add_argument("--testdata", help="directory of the TPC-H-style test tables")
        src.add_argument("--parquet", help="directory with one parquet dataset per table")
        src.add_argument("--catalog", help="database of bucketed catalog tables")
        src.add_argument("--jdbc", help="JDBC URL of the bank's database (see sources.jdbc_url)")
        p.add_argument("--property", action="append", default=[], metavar="NAME=VALUE",
                       help="JDBC property (user, password, driver, ...)")
        p.add_argument("--param", action="append", default=[], metavar="NAME=VALUE",
                       help="parameter of the query (k=None, as_of=2024-06-30, above=1000, ...)")
        p.add_argument("--out", help="output path (a directory per query for blocks)")
        p.add_argument("--format", default="parquet", choices=["parquet", "json", "csv", "orc"])
        p.add_argument("--mode", default="errorifexists",
                       choices=["errorifexists", "overwrite", "append", "ignore"])
        p.add_argument("--show", type=int, default=0, help="print the first N rows")
    args = parser.parse_args(argv)

    if args.command == "list":
        for d in REGISTRY.values():
            print(f"{d.key}\t{d.block}\t{d.title}")
        return 0

    spark = configure(SparkSession.builder.appName("bancalyt").getOrCreate())
    tables = _source(spark, args)
    if args.command == "run":
        frames = {args.key: run(spark, args.key, tables, **_params(args.param))}
    elif args.command == "run-block":
        frames = run_block(spark, args.block, tables, **_params(args.param))
    else:
        frames = run_all(spark, tables, **_params(args.param))
    for key, df in frames.items():
        _emit(key, df, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
