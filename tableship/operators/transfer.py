"""Copy of a dataset to another place, as a Spark job."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableship.functions.paths import default_store, inside, plain_name, plain_path, store_of
from tableship.session import sibling_session, timestamp_statistics
from tableship.sources.manifest import file_manifest
from tableship.sources.resolve import exists, read_dataset

SPLIT_BYTES = 1 << 30
LOG_FOLDER = "_transfer"

CHUNK_OUTCOME = "rel_path string, start bigint, size bigint, sha256 string, error string"
FILE_OUTCOME = (
    "rel_path string, bytes bigint, chunks bigint, reused bigint, ok boolean, error string"
)
#: What a task writes down of a chunk once its bytes are on disk.
JOURNAL = "rel_path string, start bigint, size bigint, length bigint, modified bigint, sha256 string"


class TransferError(RuntimeError):
    """Some files did not arrive."""


def transfer_dataset(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    mode: str = "rewrite",
    strict: bool = True,
    merge_schema: bool = False,
    resume: bool = False,
    **options,
) -> DataFrame:
    """Copy the Parquet dataset ``source`` to ``target``.

    ``rewrite`` reads and writes rows: any file system Spark reaches, small files are
    merged and large ones split at row groups. Partition directories keep their layout and
    their values as text, so ``'007'`` stays that. A target that is there already is refused.
    Returns the copy as a DataFrame.
    ``files`` copies bytes, for folders that all executors mount: see ``copy_files``.
    Returns one outcome row per file.

    ``resume`` goes on with a copy to this target that did not end: ``rewrite`` writes it anew
    unless it carries the mark of a finished write, ``files`` copies what is missing.
    """
    store = default_store(spark)
    if inside(target, source, store) or inside(source, target, store):
        raise ValueError(f"{target} overlaps {source}")
    if mode == "rewrite":
        as_text = {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}
        session = sibling_session(spark, **as_text)
        rows = read_dataset(session, source, merge_schema)
        # A scan that lists all files on its own does not see partition columns.
        stored = session.read.option("recursiveFileLookup", "true").parquet(source).columns
        partitions = [c for c in rows.columns if c not in stored]
        if resume and exists(spark, f"{target.rstrip('/')}/_SUCCESS"):
            return session.read.parquet(target)
        with timestamp_statistics(session):
            writer = rows.write.mode("overwrite" if resume else "errorifexists")
            (writer.partitionBy(*partitions) if partitions else writer).parquet(target)
        return session.read.parquet(target)
    if mode == "files":
        return copy_files(spark, source, target, strict=strict, resume=resume, **options)
    raise ValueError(f"unknown mode {mode!r}")


def copy_files(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    strict: bool = True,
    split_bytes: int = SPLIT_BYTES,
    attempts: int = 3,
    check_content: bool = True,
    replace: bool = False,
    resume: bool = False,
) -> DataFrame:
    """Byte copy of every visible file below ``source``, one outcome row per file.

    Files are cut into chunks of ``split_bytes`` that are copied independently, so one
    huge file is spread over many tasks. Chunks land in a hidden file beside the final
    name; once all chunks of a file are there it is renamed, so a reader never sees half
    a file and a repeated task only writes the same bytes again. ``check_content`` reads
    every chunk back in a second job, so that a file with a hole is not finished. Outcomes are
    kept in ``{target}/_transfer``.

    Tasks keep a journal there of the chunks they have written, line by line. ``resume`` goes on
    with the last copy to this target, however it ended (a lost driver, failed files): chunks
    in its journal, of source files whose length and time are unchanged, are read back in the
    target, and only those that are missing or differ are copied. ``reused`` is the number of
    chunks of a file that were found to be there. Without an earlier copy it is a new one.

    Both folders have to be mounted by the driver and all executors: other schemes than
    ``file`` are refused, and every task looks for a mark the driver has left in the target.
    A target with visible files the source does not have is refused unless ``replace`` is set
    (they then stay beside the copied ones), as is a source with hidden data such as a
    table's log, which a copy of visible files would leave behind.
    """
    store = default_store(spark)
    for place in (source, target):
        if store_of(place, store) != "file://":
            raise ValueError(f"{place} is not a mounted folder; use mode='rewrite'")
    _refuse_hidden_folders(plain_path(source))
    manifest = file_manifest(spark, source, include_empty=True)
    if not replace and os.path.isdir(plain_path(target)):
        there = file_manifest(spark, target, include_empty=True)
        strange = there.join(manifest, "rel_path", "left_anti").select("rel_path").head(1)
        if strange:
            raise TransferError(f"{target} holds other files, such as {strange[0]['rel_path']}")
    starts = F.sequence(
        F.lit(0).cast("bigint"),
        F.greatest(F.col("length") - 1, F.lit(0)),
        F.lit(split_bytes).cast("bigint"),
    )
    size = F.least(F.col("length") - F.col("start"), F.lit(split_bytes))
    chunks = manifest.select(
        "rel_path",
        plain_name(F.col("path")).alias("source"),
        "length",
        F.coalesce(F.unix_micros("modified"), F.lit(0)).alias("since"),
        F.explode(starts).alias("start"),
    ).select(
        "rel_path", "source", "start", size.alias("size"), "length", F.col("since").alias("modified")
    )

    root = plain_path(target)
    earlier = _last_transfer(root) if resume else None
    transfer_id = earlier or uuid.uuid4().hex
    journal = f"{root}/{LOG_FOLDER}/{transfer_id}/journal"
    log = f"{target.rstrip('/')}/{LOG_FOLDER}/{transfer_id}/run-{uuid.uuid4().hex}"
    mark = os.path.join(root, LOG_FOLDER, f"mark-{transfer_id}")
    os.makedirs(journal, exist_ok=True)
    with open(mark, "w") as file:
        file.write(transfer_id)
    check = _chunk_checker(root, transfer_id)

    present = None
    if earlier:
        present = _journaled(spark, journal, chunks, check, f"{log}/present")
        chunks = chunks.join(present, ["rel_path", "start"], "left_anti")
    tasks = _task_count(spark, chunks)
    copier = _chunk_copier(root, transfer_id, attempts, mark, journal)
    copied = chunks.repartition(tasks).mapInPandas(copier, CHUNK_OUTCOME)
    copied.write.parquet(f"{log}/chunks")

    # The log is read back, so nothing below can trigger the copy a second time.
    arrived = spark.read.schema(CHUNK_OUTCOME).parquet(f"{log}/chunks")
    if check_content:
        read_back = arrived.repartition(tasks).mapInPandas(check, CHUNK_OUTCOME)
        read_back.write.parquet(f"{log}/checked")
        arrived = spark.read.schema(CHUNK_OUTCOME).parquet(f"{log}/checked")
    arrived = arrived.withColumn("reused", F.lit(0))
    if present is not None:
        arrived = arrived.unionByName(present.withColumn("reused", F.lit(1)))
    per_file = arrived.groupBy("rel_path").agg(
        F.sum("size").alias("bytes"),
        F.count(F.lit(1)).alias("chunks"),
        F.sum("reused").alias("reused"),
        F.max("error").alias("error"),
    )
    finished = per_file.mapInPandas(_file_finisher(root, transfer_id), FILE_OUTCOME)
    finished.write.parquet(f"{log}/files")

    outcomes = spark.read.schema(FILE_OUTCOME).parquet(f"{log}/files")
    if strict:
        failed = outcomes.where(~F.col("ok"))
        examples = failed.orderBy("rel_path").limit(5).collect()
        if examples:
            shown = "; ".join(f"{r['rel_path']}: {r['error']}" for r in examples)
            raise TransferError(f"{failed.count()} files failed, such as {shown}")
    return outcomes


def transfer_summary(outcomes: DataFrame) -> DataFrame:
    """One row ``total_files, copied, total_bytes, complete``; complete only if all arrived."""
    total = F.count(F.lit(1))
    copied = F.count_if("ok")
    return outcomes.agg(
        total.alias("total_files"),
        copied.alias("copied"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("bytes"))), F.lit(0).cast("bigint")).alias(
            "total_bytes"
        ),
        (total == copied).alias("complete"),
    )


def _last_transfer(root: str) -> str | None:
    """The copy to this folder that was begun last, of those that have a journal."""
    log = os.path.join(root, LOG_FOLDER)
    begun = []
    for name in os.listdir(log) if os.path.isdir(log) else ():
        journal = os.path.join(log, name, "journal")
        if os.path.isdir(journal):
            begun.append((os.stat(journal).st_mtime_ns, name))
    return max(begun)[1] if begun else None


def _journaled(spark, journal: str, chunks: DataFrame, check, log: str) -> DataFrame:
    """Chunks of the journal that are wanted as they were then, and are in the target."""
    # A line that a lost task has left unfinished is passed over.
    lines = spark.read.schema(JOURNAL).option("mode", "DROPMALFORMED").json(f"file://{journal}")
    same = ["rel_path", "start", "size", "length", "modified"]
    known = lines.where(F.col("sha256").isNotNull()).dropDuplicates([*same, "sha256"])
    known = chunks.select(*same).join(known, same)
    known = known.select("rel_path", "start", "size", "sha256", F.lit(None).cast("string").alias("error"))
    known.repartition(_task_count(spark, known)).mapInPandas(check, CHUNK_OUTCOME).write.parquet(log)
    found = spark.read.schema(CHUNK_OUTCOME).parquet(log).where("error IS NULL")
    # Written twice, a chunk may be known by two checksums; only one of them can be there.
    return found.dropDuplicates(["rel_path", "start"])


def _task_count(spark: SparkSession, chunks: DataFrame) -> int:
    """About 1 GiB for each task, but never more tasks than chunks."""
    totals = chunks.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    wanted = max(spark.sparkContext.defaultParallelism, (totals["bytes"] or 0) // SPLIT_BYTES)
    return max(1, min(totals["n"], wanted))


#: Folders that Spark jobs leave in a dataset and that hold no data.
_MARKERS = ("_temporary", LOG_FOLDER, "_committed", "_started")


def _refuse_hidden_folders(root: str) -> None:
    """Look at folders only, one at a time; their files are left to the manifest."""
    if not os.path.isdir(root):
        return
    for folder, below, _ in os.walk(root):
        hidden = [d for d in below if d[0] in "._" and "=" not in d and d not in _MARKERS]
        if hidden:
            raise TransferError(f"{folder}/{hidden[0]} would be left behind by a copy of files")
        below[:] = [d for d in below if d not in _MARKERS]


# The functions below run inside tasks. They import what they need themselves, so
# that workers do not need this package on their path.


def _chunk_checker(target_root, transfer_id):
    def check_batches(batches):
        import hashlib
        import os

        import pandas as pd

        def check(rel_path, start, size, sha256, error):
            if isinstance(error, str):
                return error
            folder, name = os.path.split(os.path.join(target_root, rel_path))
            part = os.path.join(folder, f".{name}.{transfer_id}")
            sha = hashlib.sha256()
            try:
                # A file that an earlier run has finished has its own name.
                with open(part if os.path.exists(part) else os.path.join(folder, name), "rb") as f:
                    f.seek(start)
                    left = size
                    while left and (data := f.read(min(8 << 20, left))):
                        sha.update(data)
                        left -= len(data)
            except OSError as e:
                return f"{type(e).__name__}: {e}"
            if left or sha.hexdigest() != sha256:
                return f"{rel_path} differs from its source at {start}"
            return None

        columns = ["rel_path", "start", "size", "sha256", "error"]
        for batch in batches:
            rows = [
                (r, int(a), int(n), h, check(r, int(a), int(n), h, e))
                for r, a, n, h, e in zip(*(batch[c] for c in columns))
            ]
            yield pd.DataFrame(rows, columns=columns)

    return check_batches


def _chunk_copier(target_root, transfer_id, attempts, mark, journal=None):
    def copy_batches(batches):
        import hashlib
        import json
        import os
        import uuid

        import pandas as pd

        block = 8 << 20
        lines = journal and os.path.join(journal, f"{uuid.uuid4().hex}.json")

        def blocks(path, start, size):
            with open(path, "rb") as f:
                f.seek(start)
                while size:
                    data = f.read(min(block, size))
                    if not data:
                        raise OSError(f"{path} ends {size} bytes early")
                    size -= len(data)
                    yield data

        def shared():
            try:
                with open(mark) as f:
                    return f.read() == transfer_id
            except OSError:
                return False

        def note(chunk, sha256):
            kept = ("rel_path", "start", "size", "length", "modified")
            with open(lines, "a") as f:
                f.write(json.dumps({c: chunk[c] for c in kept} | {"sha256": sha256}) + "\n")
                f.flush()
                os.fsync(f.fileno())

        def copy(rel_path, source, start, size, length=None, **_):
            if not shared():
                raise OSError(f"{target_root} here is not the folder the driver sees")
            final = os.path.join(target_root, rel_path)
            folder, name = os.path.split(final)
            part = os.path.join(folder, f".{name}.{transfer_id}")
            os.makedirs(folder, exist_ok=True)
            sha = hashlib.sha256()
            out = os.open(part, os.O_WRONLY | os.O_CREAT, 0o644)
            try:
                at = start
                for data in blocks(source, start, size):
                    sha.update(data)
                    view = memoryview(data)
                    while view:
                        n = os.pwrite(out, view, at)
                        view, at = view[n:], at + n
                # An earlier run may have begun with a longer file of that name.
                if length is not None and os.fstat(out).st_size > length:
                    os.ftruncate(out, length)
                os.fsync(out)
            finally:
                os.close(out)
            return sha.hexdigest()

        def outcome(chunk):
            place = chunk["rel_path"], chunk["start"], chunk["size"]
            for attempt in range(1, attempts + 1):
                try:
                    sha256 = copy(**chunk)
                    if lines:
                        note(chunk, sha256)
                    return *place, sha256, None
                except OSError as e:
                    if attempt == attempts:
                        return *place, None, f"{type(e).__name__}: {e}"

        columns = ["rel_path", "start", "size", "sha256", "error"]
        for batch in batches:
            rows = [outcome(chunk) for chunk in batch.to_dict("records")]
            yield pd.DataFrame(rows, columns=columns)

    return copy_batches


def _file_finisher(target_root, transfer_id):
    def finish_batches(batches):
        import os

        import pandas as pd

        def finish(rel_path, size, error):
            if error:
                return error
            final = os.path.join(target_root, rel_path)
            folder, name = os.path.split(final)
            part = os.path.join(folder, f".{name}.{transfer_id}")
            try:
                if os.path.exists(part):
                    os.replace(part, final)
                arrived = os.path.getsize(final)
            except OSError as e:
                return f"{type(e).__name__}: {e}"
            return None if arrived == size else f"{arrived} of {size} bytes arrived"

        columns = ["rel_path", "bytes", "chunks", "reused", "ok", "error"]
        for batch in batches:
            rows = []
            for r, size, n, reused, error in zip(
                *(batch[c] for c in ("rel_path", "bytes", "chunks", "reused", "error"))
            ):
                error = finish(r, int(size), error if isinstance(error, str) else None)
                rows.append((r, int(size), int(n), int(reused), error is None, error))
            yield pd.DataFrame(rows, columns=columns)

    return finish_batches
