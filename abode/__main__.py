"""Command-line entry for the three programmes (works under spark-submit).

    python -m abode attributes --input feed1_db=... --input feed1_sheet=... ... --out OUT
    python -m abode measures   --input claims=... --input directory=... ... --out OUT --as-of 2025-04-01
    python -m abode import     --input master=... --input history=... --out OUT --as-of 2025-04-01
    python -m abode update     --input claims=... --input directory=... --input pcon_lookup=... --out OUT --as-of ...
    python -m abode provenance --master M --table-list L --tables-root R --population P --out OUT --as-of ...

Inputs ending in ``.csv`` (or folders of CSV given with ``csv:`` prefix) are
read as all-text CSV with a header; ``sheet:PATH`` is a landed worksheet, whose
landing order becomes ``seq``, and ``sheet+N:PATH`` one with N banner lines above
the header; everything else is Parquet. The checkpoint folder comes from
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import re
import sys

from pyspark.sql import DataFrame, SparkSession

from abode.session import build_session
from abode.sources.landed import read_extract, read_landed


def _read(spark: SparkSession, spec: str) -> DataFrame:
    sheet = re.match(r"sheet(?:\+(\d+))?:(.*)", spec)
    if sheet:
        return read_landed(spark, sheet[2], banner_rows=int(sheet[1] or 0))
    return read_extract(spark, spec)


def _inputs(spark: SparkSession, pairs: list[str]) -> dict[str, DataFrame]:
    out = {}
    for pair in pairs:
        name, _, path = pair.partition("=")
        out[name] = _read(spark, path)
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    parser = argparse.ArgumentParser(prog="abode")
    sub = parser.add_subparsers(dest="command", required=True)
    a = sub.add_parser("attributes", help="attribute resolution -> attribute tables and masters")
    a.add_argument("--input", action="append", default=[], help="name=path (feed1_db, feed1_sheet, ...)")
    a.add_argument("--out", required=True)
    m = sub.add_parser("measures", help="annual measures -> extracts and new master versions")
    m.add_argument("--input", action="append", default=[],
                   help="name=path (claims, directory, pcon_lookup, previous_master, previous_history)")
    m.add_argument("--out", required=True)
    m.add_argument("--as-of", required=True)
    m.add_argument("--lenient", action="store_true", help="route gate offenders instead of stopping")
    m.add_argument("--replace-label", action="store_true", help="replace rows of the same FY label")
    b = sub.add_parser("import", help="publish both cumulative masters in parts, for update")
    b.add_argument("--input", action="append", default=[], help="name=path (master, history)")
    b.add_argument("--out", required=True)
    b.add_argument("--as-of", required=True)
    u = sub.add_parser("update", help="annual measures on the masters published in parts; changed years only")
    u.add_argument("--input", action="append", default=[], help="name=path (claims, directory, pcon_lookup)")
    u.add_argument("--out", required=True)
    u.add_argument("--as-of", required=True)
    u.add_argument("--lenient", action="store_true", help="route gate offenders instead of stopping")
    u.add_argument("--replace-label", action="store_true", help="replace rows of the same FY label")
    u.add_argument("--reports", action="store_true", help="write both report CSVs of the whole masters")
    p = sub.add_parser("provenance", help="provenance extract (47 columns)")
    p.add_argument("--master", required=True)
    p.add_argument("--table-list", required=True)
    p.add_argument("--tables-root", required=True, help="folder holding one table per listed name")
    p.add_argument("--population", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--as-of", required=True)
    args = parser.parse_args(argv)

    from abode.plans import runs

    spark = spark or build_session()
    if args.command == "attributes":
        result = runs.run_attribute_resolution(_inputs(spark, args.input), args.out)
    elif args.command == "measures":
        i = _inputs(spark, args.input)
        result = runs.run_annual_measures(
            i["claims"], i["directory"], i["pcon_lookup"], i["previous_master"], i["previous_history"],
            args.out, dt.date.fromisoformat(args.as_of), strict=not args.lenient,
            replace_label=args.replace_label)
    elif args.command == "import":
        i = _inputs(spark, args.input)
        result = runs.import_masters(i["master"], i["history"], args.out, dt.date.fromisoformat(args.as_of))
    elif args.command == "update":
        i, as_of = _inputs(spark, args.input), dt.date.fromisoformat(args.as_of)
        result = runs.run_annual_update(i["claims"], i["directory"], i["pcon_lookup"], args.out, as_of,
                                        strict=not args.lenient, replace_label=args.replace_label)
        if args.reports:
            result |= runs.write_reports(spark, args.out, as_of)
    else:
        tables = runs.load_listed_tables(
            spark, _read(spark, args.table_list),
            lambda name: _read(spark, f"{args.tables_root.rstrip('/')}/{name}"))
        path, report = runs.run_provenance_extract(
            _read(spark, args.master), tables, _read(spark, args.population), args.out,
            dt.date.fromisoformat(args.as_of))
        result = {"extract": path, **report}
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
    sys.exit(0)
