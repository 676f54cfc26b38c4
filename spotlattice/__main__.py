"""Runs one query from the command line: python -m spotlattice QUERY TABLES OUT (or --query, --tables, --out)."""

from __future__ import annotations

import argparse


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    """Flags or places, as one likes; a flag wins over a place."""
    p = argparse.ArgumentParser(prog="spotlattice", description=__doc__)
    names = ("query", "tables", "out")
    for n in names:
        p.add_argument(f"--{n}", dest=f"flag_{n}")
    p.add_argument("places", nargs="*", help="query, tables and out, those without a flag, in this order")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    p.add_argument("--dry-run", action="store_true")
    a = p.parse_intermixed_args(argv)
    left = list(a.places)
    for n in names:
        setattr(a, n, getattr(a, f"flag_{n}") or (left.pop(0) if left else None))
    if left or not (a.query and a.tables and a.out):
        p.error("query, tables and out are needed, once each")
    return a


def main(argv: list[str] | None = None) -> None:
    from pyspark.sql import SparkSession

    from .catalogue import QUERIES

    a = arguments(argv)
    if a.query not in QUERIES:
        raise SystemExit(f"no query {a.query}; there are {', '.join(sorted(QUERIES))}")
    spark = SparkSession.builder.appName(f"spotlattice {a.query}").getOrCreate()
    df = QUERIES[a.query](spark, a.tables)
    if a.dry_run:
        df.explain("formatted")
    else:
        df.write.mode("overwrite").option("header", True).format(a.format).save(a.out)


if __name__ == "__main__":
    main()
