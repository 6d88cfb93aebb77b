"""Command line: run the document jobs on a folder of parquet tables.

  python -m docroll rollup-job --data DIR --target DIR [--format json] [--cutoff 2010-01-01]
  python -m docroll order-docs --data DIR --target DIR
  python -m docroll customer-docs --data DIR --target DIR
  python -m docroll three-level-docs --data DIR --target DIR
  python -m docroll sql-nest --data DIR --target DIR
  python -m docroll search --data DIR --table part --term ring [--target DIR]
  python -m docroll query NAME --data DIR [--target DIR]

``--input-format delimited`` runs the document jobs from ``;`` text.
Works the same under ``spark-submit`` (the master then comes from it).
Documents go to ``--target`` through any Spark data source (``--format``,
``--option key=value``); ``--legacy-names`` writes the original field
spellings.
"""

from __future__ import annotations

import argparse
import json

from docroll.functions.scalars import REFERENCE_BUCKET_THRESHOLDS, REFERENCE_CUTOFF
from docroll.operators.joins import ORPHAN_POLICIES
from docroll.operators.nest import PAGE_SIZE
from docroll.session import build_session


#: Layout of each table's delimited text.
JOB_LAYOUTS = {"customer": "customer_join", "orders": "order_rollup", "lineitem": "order_line_rollup", "events": "contact_typed"}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="docroll")
    p.add_argument("command", choices=[
        "rollup-job", "order-docs", "customer-docs", "three-level-docs", "sql-nest", "search", "query",
    ])
    p.add_argument("name", nargs="?", help="registered query name (for 'query')")
    p.add_argument("--data", required=True, help="folder with <table>.parquet files")
    p.add_argument("--target", help="output folder")
    p.add_argument("--format", default="json")
    p.add_argument("--option", action="append", default=[], help="writer option key=value")
    p.add_argument("--mode", default="overwrite")
    p.add_argument("--master", default=None)
    p.add_argument("--shuffle-partitions", type=int, default=None)
    p.add_argument("--cutoff", default=REFERENCE_CUTOFF)
    p.add_argument("--thresholds", default=",".join(str(t) for t in REFERENCE_BUCKET_THRESHOLDS))
    p.add_argument("--page-size", type=int, default=PAGE_SIZE, help="items of one document page; 0: one document per parent")
    p.add_argument("--missing", choices=ORPHAN_POLICIES, default="report", help="rows without a partner (rollup-job)")
    p.add_argument("--input-format", choices=["parquet", "delimited"], default="parquet",
                   help="delimited: <data>/<table> holds ';' text in the rollup job's layouts")
    p.add_argument("--table", default="part")
    p.add_argument("--term")
    p.add_argument("--legacy-names", action="store_true")
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    from docroll.plans import catalog, stateful  # noqa: F401 (stateful adds to the catalog)
    from docroll.plans import documents as D
    from docroll.plans import sql_text as S
    from docroll.plans.columns import LAYOUT_COLUMNS, TABLE_COLUMNS
    from docroll.sinks.documents import rename_fields, write_docs
    from docroll.sources.delimited import read_delimited
    from docroll.sources.schemas import LAYOUTS
    from docroll.sources.search import search
    from docroll.sources.tables import table

    spark = build_session(args.master, shuffle_partitions=args.shuffle_partitions)
    options = dict(o.split("=", 1) for o in args.option)
    page_size = args.page_size or None
    thresholds = [float(t) for t in args.thresholds.split(",")]

    columns = TABLE_COLUMNS if args.input_format == "parquet" else LAYOUT_COLUMNS

    def t(name):
        if args.input_format == "parquet":
            return table(spark, args.data, name)
        return read_delimited(spark, f"{args.data.rstrip('/')}/{name}", LAYOUTS[JOB_LAYOUTS[name]])

    def out(df, sub=""):
        if args.target is None:
            return {"rows": df.count()}
        df = rename_fields(df) if args.legacy_names else df
        path = f"{args.target.rstrip('/')}{sub}"
        write_docs(df, path, fmt=args.format, mode=args.mode, options=options)
        return {"written": path}

    if args.command == "rollup-job":
        if not args.target:
            raise SystemExit("--target is required")
        result = D.run_rollup_job(
            spark, t("customer"), t("orders"), t("lineitem"), t("events"), args.target,
            cutoff=args.cutoff, thresholds=thresholds, fmt=args.format, options=options, mode=args.mode,
            legacy_names=args.legacy_names, missing=args.missing, page_size=page_size, columns=columns,
        )
    elif args.command == "order-docs":
        result = out(D.order_documents(t("orders"), t("lineitem"), page_size=page_size, columns=columns))
    elif args.command == "customer-docs":
        result = out(D.customer_documents(t("customer"), t("orders"), t("events"), page_size=page_size, columns=columns))
    elif args.command == "three-level-docs":
        result = out(D.three_level_documents(t("customer"), t("orders"), t("lineitem"), t("events"), page_size=page_size, columns=columns))
    elif args.command == "sql-nest":
        result = out(D.names_with_descriptions(S.right_join_count(t("customer"), t("orders")), page_size=page_size))
    elif args.command == "search":
        if not args.term:
            raise SystemExit("--term is required")
        result = out(search(t(args.table), args.term))
    else:
        if args.name not in catalog.QUERIES:
            raise SystemExit(f"unknown query; one of: {', '.join(catalog.QUERIES)}")
        result = out(catalog.QUERIES[args.name](spark, args.data))
    print(json.dumps(result))
    return result


def cli() -> int:
    """Console entry point (exit status 0 on success)."""
    main()
    return 0


if __name__ == "__main__":
    main()
