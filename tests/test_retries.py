"""Tasks that fail after their work was done, as when an executor is lost.

Local sessions of the other tests give a task one attempt, so this runs a session of its
own, which allows more, in another process.
"""

from __future__ import annotations

import os
import subprocess
import sys

SCRIPT = '''
import sys
from pyspark import TaskContext
from pyspark.sql import functions as F
import tableship as ts
from tableship.functions.hashing import fingerprint
from tableship.operators import transfer

folder = sys.argv[1]
spark = ts.get_session(
    "retries", master="local[2,4]", spark__ui__enabled="false", spark__sql__shuffle__partitions="4"
)
spark.sparkContext.setLogLevel("OFF")
events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(6)
events.write.parquet(f"{folder}/events")
events = spark.read.parquet(f"{folder}/events")
wanted = tuple(fingerprint(events).first())


def lost_once(batches):
    """Passes all rows on, then fails in the first attempt."""
    from pyspark import TaskContext

    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("executor lost")


flaky = events.mapInPandas(lost_once, events.schema)
for order_by in (None, "ts"):
    for repeatable in (True, False):
        source = ts.Source(flaky, "flaky", repeatable)
        export = ts.export_dataset(
            source, f"{folder}/out", f"{order_by}-{repeatable}", order_by=order_by, rows_per_file=150
        )
        assert (export.row_count, export.content_hash) == wanted, (order_by, repeatable)
        assert tuple(fingerprint(spark.read.parquet(export.path)).first()) == wanted

for name in ("_chunk_copier", "_file_finisher"):
    def failing(*args, made=getattr(transfer, name)):
        work = made(*args)

        def run(batches):
            from pyspark import TaskContext

            yield from work(batches)
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("executor lost")

        return run

    setattr(transfer, name, failing)

outcomes = ts.copy_files(spark, f"{folder}/events", f"{folder}/copy", split_bytes=5000)
assert ts.transfer_summary(outcomes).first()["complete"]
assert outcomes.count() == 6
assert tuple(fingerprint(spark.read.parquet(f"{folder}/copy")).first()) == wanted
print("survived")
'''


def test_tasks_lost_at_their_end(folder):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.pathsep.join(filter(None, [root, os.environ.get("PYTHONPATH")]))
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, folder],
        env={**os.environ, "PYTHONPATH": path},
        capture_output=True,
        text=True,
        timeout=600,
    )
    assert done.stdout.strip().endswith("survived"), done.stderr[-3000:]
