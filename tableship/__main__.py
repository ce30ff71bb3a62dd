"""The steps of a migration from the command line: ``python -m tableship <step> --help``.

Each step prints its result tables and exits with 1 where a check failed.
"""

from __future__ import annotations

import argparse
import sys

import tableship as ts


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = ts.get_session(f"tableship-{args.step}")
    return args.run(spark, args)


def _export(spark, args) -> int:
    export = ts.export_dataset(
        _source(spark, args),
        args.root,
        args.name,
        version=args.version,
        order_by=args.time,
        tie_break=args.tie_break,
        rows_per_file=args.rows_per_file,
    )
    ts.export_summary(spark, export).show(truncate=False)
    checked = ts.verify_export(spark, export)
    checked.show()
    return 0 if checked.first()["matches"] else 1


def _transfer(spark, args) -> int:
    if args.mode == "rewrite":
        copy = ts.transfer_dataset(spark, args.source, args.target)
        compared = ts.verify_import(ts.read_dataset(spark, args.source), copy, strict=False)
        compared.show()
        return 0 if compared.first()["matches"] else 1
    outcomes = ts.transfer_dataset(spark, args.source, args.target, mode="files", strict=False)
    outcomes.where("NOT ok").show(truncate=False)
    summary = ts.transfer_summary(outcomes)
    summary.show()
    return 0 if summary.first()["complete"] else 1


def _import(spark, args) -> int:
    ts.target_snapshot(spark, args.table).show(truncate=False)
    ts.null_counts(ts.read_dataset(spark, args.path)).show()
    ts.publish_table(spark, args.table, path=args.path, validate_source=not args.no_validation)
    ts.table_info(spark, args.table).show(truncate=False)
    compared = ts.verify_import(
        ts.read_dataset(spark, args.path), spark.table(args.table), strict=False
    )
    compared.show()
    return 0 if compared.first()["matches"] else 1


def _verify(spark, args) -> int:
    table = spark.table(args.table)
    ts.table_schema(table).show(1000, truncate=False)
    recent = ts.recent_records(table, args.time, 5, [args.id] if args.id else None)
    ts.preview(recent).show(truncate=False)
    ts.date_distribution(table, args.time).show()
    return _show_report(ts.verification_report(table, args.time, id_column=args.id))


def _migrate(spark, args) -> int:
    done = ts.migrate(
        spark,
        _source(spark, args),
        args.root,
        args.import_root,
        args.name,
        args.target_table,
        time_column=args.time,
        id_column=args.id,
        version=args.version,
        transfer_mode=args.mode,
        strict=not args.lenient,
        resume=args.resume,
        journal=args.journal,
        rows_per_file=args.rows_per_file,
    )
    return _show_report(done.report)


def _show_report(report) -> int:
    report.show(truncate=False)
    return 0 if report.where("NOT passed").isEmpty() else 1


def _source(spark, args) -> ts.Source:
    return ts.resolve_source(spark, table=args.table, sql=args.sql, path=args.path)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tableship")
    steps = parser.add_subparsers(dest="step", required=True)

    source = argparse.ArgumentParser(add_help=False)
    one = source.add_mutually_exclusive_group(required=True)
    one.add_argument("--table")
    one.add_argument("--sql")
    one.add_argument("--path")
    source.add_argument("--root", required=True, help="folder of the exports")
    source.add_argument("--name", required=True, help="name of the dataset")
    source.add_argument("--version", help="default: the current time")
    source.add_argument("--rows-per-file", type=int, default=100_000)

    step = steps.add_parser("export", parents=[source], help="write a source as Parquet")
    step.add_argument("--time", help="column to order by, newest first")
    step.add_argument("--tie-break", nargs="*", default=[])
    step.set_defaults(run=_export)

    step = steps.add_parser("transfer", help="copy a dataset")
    step.add_argument("source")
    step.add_argument("target")
    step.add_argument("--mode", choices=["rewrite", "files"], default="rewrite")
    step.set_defaults(run=_transfer)

    step = steps.add_parser("import", help="publish a dataset as a table")
    step.add_argument("path")
    step.add_argument("table")
    step.add_argument("--no-validation", action="store_true")
    step.set_defaults(run=_import)

    step = steps.add_parser("verify", help="check a table")
    step.add_argument("table")
    step.add_argument("--time", required=True)
    step.add_argument("--id")
    step.set_defaults(run=_verify)

    step = steps.add_parser("migrate", parents=[source], help="all steps in order")
    step.add_argument("--import-root", required=True)
    step.add_argument("--target-table", required=True)
    step.add_argument("--time", required=True)
    step.add_argument("--id")
    step.add_argument("--mode", choices=["rewrite", "files", "none"], default="rewrite")
    step.add_argument("--lenient", action="store_true")
    step.add_argument("--resume", metavar="VERSION", help="go on with a run that did not end")
    step.add_argument("--journal", help="folder of the outcomes of steps, as in the run before")
    step.set_defaults(run=_migrate)
    return parser


if __name__ == "__main__":
    sys.exit(main())
