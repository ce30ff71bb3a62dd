"""The whole way of a table: export, verify, copy, publish, verify."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tableship.functions.paths import dataset_path, new_version
from tableship.operators.export import Export, export_dataset
from tableship.operators.publish import publish_table
from tableship.operators.transfer import transfer_dataset
from tableship.plans.journal import Journal
from tableship.plans.verify import REPORT, verification_report, verify_export
from tableship.session import shared_folder
from tableship.sources.resolve import Source, exists, read_dataset


@dataclass(frozen=True)
class Migration:
    export: Export
    table: str
    location: str
    report: DataFrame


def migrate(
    spark: SparkSession,
    source: Source,
    export_root: str,
    import_root: str,
    name: str,
    target_table: str,
    *,
    time_column: str,
    id_column: str | None = None,
    ordered: bool = True,
    version: str | None = None,
    transfer_mode: str = "rewrite",
    properties: dict[str, str] | None = None,
    check_export: bool = False,
    check_ids: bool = True,
    strict: bool = True,
    resume: str | None = None,
    journal: str | None = None,
    **export_options,
) -> Migration:
    """Move ``source`` into ``target_table`` and report whether the rows arrived.

    The copy lands where the table will read it. It is checked there, against the hash
    taken while the source was exported, and only then the table is pointed at it: with
    ``strict`` rows that fail a check never go live, otherwise the report says so.
    ``check_export`` adds a read-back of the export before the copy. ``transfer_mode="none"``
    leaves the copy out, for a target that can read the export where it is. ``check_ids=False``
    leaves out the distinct count of ids, the one check that shuffles a value of every row.

    Neither export nor copy ever writes into a folder that is there already, so the rows a
    live table shows stay as they are until the switch.

    Each step leaves its outcome in ``journal`` (by default a folder in the shared folder). After
    a failure or a lost driver ``resume=version``, with the other arguments as before, goes on
    with the first step that has not ended: an export that has ended is not read from its
    source again, a copy of files takes over the chunks that are there, what an unfinished
    step has written is written anew, and a table that was switched is not switched again.
    An error names the version to go on with.
    """
    if resume and version not in (None, resume):
        raise ValueError(f"version {version} cannot go on with {resume}")
    version = resume or version or new_version()
    run = Journal(
        spark,
        journal or f"{shared_folder(spark)}/tableship/journals",
        {
            "version": version, "source": source.label, "export_root": export_root,
            "import_root": import_root, "name": name, "target_table": target_table,
            "time_column": time_column, "id_column": id_column, "ordered": ordered,
            "transfer_mode": transfer_mode,
        },
    )
    if resume:
        if not run.resume():
            raise ValueError(f"no run of version {resume} with these settings to go on with")
        export_options["mode"] = "overwrite"
    elif export_options.get("mode", "errorifexists") == "errorifexists":
        # Asked before the journal starts: what is there is not this run's to write anew.
        for root in (export_root, import_root) if transfer_mode != "none" else (export_root,):
            if exists(spark, dataset_path(root, name, version)):
                raise FileExistsError(f"{dataset_path(root, name, version)} already exists")
    if not resume:
        run.start()

    try:
        return _steps(
            spark, source, export_root, import_root, name, target_table, run,
            time_column=time_column, id_column=id_column, ordered=ordered, version=version,
            transfer_mode=transfer_mode, properties=properties, check_export=check_export,
            check_ids=check_ids, strict=strict, resumed=bool(resume), **export_options,
        )
    except Exception as error:
        error.add_note(f"migrate(resume={version!r}) goes on from here")
        raise


def _steps(
    spark, source, export_root, import_root, name, target_table, run, *, time_column, id_column,
    ordered, version, transfer_mode, properties, check_export, check_ids, strict, resumed,
    **export_options,
) -> Migration:
    exported = run.outcome("export")
    if exported:
        export = Export(**{**exported, "content_hash": Decimal(exported["content_hash"])})
    else:
        export = export_dataset(
            source,
            export_root,
            name,
            version=version,
            order_by=time_column if ordered else None,
            tie_break=[id_column] if id_column else (),
            **export_options,
        )
        run.done("export", **{**asdict(export), "content_hash": str(export.content_hash)})
    if check_export and not run.outcome("export_check"):
        verify_export(spark, export)
        run.done("export_check", path=export.path)

    location = export.path
    if transfer_mode != "none":
        location = dataset_path(import_root, name, version)
        if not run.outcome("transfer"):
            transfer_dataset(spark, export.path, location, mode=transfer_mode, resume=resumed)
            run.done("transfer", location=location)

    checked = run.outcome("checks")
    if checked and all(passed for _, passed, _ in checked["report"]):
        report = _report(spark, checked["report"])
    else:
        report = verification_report(
            read_dataset(spark, location),
            time_column,
            id_column=id_column,
            check_ids=check_ids,
            expected_rows=export.row_count,
            expected_hash=export.content_hash,
            expected_schema=source.frame.schema,
        )
        rows = [tuple(row) for row in report.collect()]
        run.done("checks", report=rows)
        failed = [check for check, passed, _ in rows if not passed]
        if failed and strict:
            raise MigrationError(f"{location} failed: {', '.join(failed)}")

    if not run.outcome("publish"):
        publish_table(
            spark,
            target_table,
            path=location,
            version=version,
            properties={"tableship.source": export.source, **(properties or {})},
            validate_source=False,
        )
        run.done("publish", table=target_table)
    live = spark.table(target_table).count()
    published = ("published", live == export.row_count, f"{target_table} shows {live:,} rows")
    return Migration(export, target_table, location, report.unionByName(_report(spark, [published])))


def _report(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame(rows, REPORT)


class MigrationError(RuntimeError):
    """The target does not pass its checks."""
