"""The library's operators as named queries over the test tables, each with the SQL that
gives the same rows. Every query reads whole tables; writers use the shared folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tableship as ts
from tableship.functions.paths import new_version, plain_path
from tableship.operators.publish import ensure_namespace
from tableship.session import fresh_folder

QUERIES = {}
ORACLES = {}


def query(sql: str | None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _source(spark: SparkSession, sf_dir: str, name: str) -> ts.Source:
    return ts.resolve_source(spark, path=f"{sf_dir}/{name}.parquet")


def _export(spark: SparkSession, sf_dir: str, name: str, **options) -> ts.Export:
    root = fresh_folder(spark, "export")
    return ts.export_dataset(_source(spark, sf_dir, name), root, name, **options)


def _table_name(name: str) -> str:
    """Name of a target table that no earlier run of this query has used."""
    return f"tableship_queries.{name}_{uuid.uuid4().hex[:12]}"


# Profiles


@query(
    "SELECT count(*) AS total_rows, min(ts) AS earliest, max(ts) AS latest, "
    "count(*) - count(nullif(event_type, 'click')) AS event_type_nulls, "
    "CAST(0 AS BIGINT) AS event_id_nulls, CAST(greatest(1, count(*) // 3000) AS BIGINT) AS files, "
    "CAST(1 AS BIGINT) AS schemas FROM events"
)
def footer_profile(spark, sf_dir):
    """Counts, nulls and range of an export in several files, from its footers alone."""
    events = _table(spark, sf_dir, "events").withColumn(
        "event_type", F.nullif("event_type", F.lit("click"))
    )
    source = ts.resolve_source(spark, frame=events)
    root = fresh_folder(spark, "export")
    export = ts.export_dataset(source, root, "events", order_by="ts", rows_per_file=3_000)
    index = ts.footer_index(spark, export.path)
    nulls = ts.indexed_null_counts(index).select(
        F.col("event_type").alias("event_type_nulls"), F.col("event_id").alias("event_id_nulls")
    )
    schemas = ts.schema_versions(index).agg(
        F.sum("files").alias("files"), F.count(F.lit(1)).alias("schemas")
    )
    # One row each.
    return ts.indexed_row_count(index).join(ts.indexed_range(index, "ts")).join(nulls).join(schemas)


@query(
    "SELECT CAST(1 AS BIGINT) AS files, count(*) FILTER (o_orderkey % 2 = 0) AS row_count, "
    "true AS has_status FROM orders "
    "UNION ALL SELECT 1, count(*) FILTER (o_orderkey % 2 = 1), false FROM orders"
)
def footer_schema_versions(spark, sf_dir):
    """A folder whose files do not share a schema: each schema with its files and rows."""
    orders, folder = _table(spark, sf_dir, "orders"), fresh_folder(spark, "mixed")
    orders.where("o_orderkey % 2 = 0").coalesce(1).write.parquet(folder)
    odd = orders.where("o_orderkey % 2 = 1").drop("o_orderstatus")
    odd.coalesce(1).write.mode("append").parquet(folder)
    found = ts.schema_versions(ts.footer_index(spark, folder))
    status = F.col("schema_text").contains("o_orderstatus")
    return found.select("files", "row_count", status.alias("has_status"))


@query("SELECT count(*) AS total_rows FROM events")
def row_count(spark, sf_dir):
    return ts.row_count(_table(spark, sf_dir, "events"))


@query("SELECT * FROM events ORDER BY ts DESC NULLS LAST, event_id DESC LIMIT 10")
def recent_records(spark, sf_dir):
    return ts.recent_records(_table(spark, sf_dir, "events"), "ts", 10, ["event_id"])


@query("SELECT * FROM orders ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC LIMIT 10")
def recent_records_ties(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    return ts.recent_records(orders, "o_orderdate", 10, ["o_orderkey"])


@query("SELECT * FROM orders ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC LIMIT 10")
def recent_records_pruned(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    return ts.recent_records(orders, "o_orderdate", 10, ["o_orderkey"], prune=True)


@query(
    "SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS record_count FROM orders "
    "GROUP BY 1 ORDER BY 1 DESC NULLS LAST LIMIT 10"
)
def date_distribution(spark, sf_dir):
    return ts.date_distribution(_table(spark, sf_dir, "orders"), "o_orderdate", 10)


@query("SELECT CAST(ts AS DATE) AS date, count(*) AS record_count FROM events GROUP BY 1")
def date_distribution_all_days(spark, sf_dir):
    return ts.date_distribution(_table(spark, sf_dir, "events"), "ts", days=None)


@query("SELECT min(ts) AS earliest, max(ts) AS latest FROM events")
def date_range(spark, sf_dir):
    return ts.date_range(_table(spark, sf_dir, "events"), "ts")


@query(
    "SELECT count(*) AS total_records, count(DISTINCT o_custkey) AS unique_ids, "
    "min(o_orderdate) AS earliest_date, max(o_orderdate) AS latest_date FROM orders"
)
def quality_summary(spark, sf_dir):
    return ts.quality_summary(_table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")


@query(
    "SELECT count(*) - count(event_id) AS event_id, count(*) - count(event_type) AS event_type, "
    "count(*) - count(value) AS value FROM (SELECT event_id, "
    "nullif(event_type, 'click') AS event_type, "
    "CASE WHEN value >= 100 THEN value END AS value FROM events) t"
)
def null_counts(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("click")).alias("event_type"),
        F.when(F.col("value") >= 100, F.col("value")).alias("value"),
    )
    return ts.null_counts(events)


@query(
    "SELECT count(*) - count(vec_id) AS vec_id, count(*) - count(embedding) AS embedding, "
    "count(*) - count(label) AS label FROM embeddings"
)
def footer_null_counts(spark, sf_dir):
    return ts.footer_null_counts(spark, f"{sf_dir}/embeddings.parquet")


@query("SELECT min(o_orderdate) AS o_orderdate_min, max(o_orderdate) AS o_orderdate_max FROM orders")
def temporal_profile(spark, sf_dir):
    return ts.temporal_profile(_table(spark, sf_dir, "orders"))


@query(
    "SELECT CAST(ordinal_position - 1 AS INTEGER) AS position, column_name AS col_name, "
    "CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' "
    "WHEN 'INTEGER' THEN 'int' ELSE lower(data_type) END AS data_type, n.row_count, "
    "CAST(0 AS BIGINT) AS null_count "
    "FROM information_schema.columns, (SELECT count(*) AS row_count FROM events) n "
    "WHERE table_name = 'events'"
)
def column_profile(spark, sf_dir):
    return ts.column_profile(_table(spark, sf_dir, "events"))


@query(
    "SELECT CAST(ordinal_position - 1 AS INTEGER) AS position, column_name AS col_name, "
    "CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' "
    "WHEN 'INTEGER' THEN 'int' ELSE lower(data_type) END AS data_type "
    "FROM information_schema.columns WHERE table_name = 'lineitem'"
)
def table_schema(spark, sf_dir):
    return ts.table_schema(_table(spark, sf_dir, "lineitem"))


@query(
    "SELECT min(o_orderdate) AS o_orderdate_min, max(o_orderdate) AS o_orderdate_max, "
    "min(o_orderkey) AS update_key_min, max(o_orderkey) AS update_key_max FROM orders"
)
def temporal_profile_by_name(spark, sf_dir):
    """Names decide: one column is a time, another only has a name that sounds like one."""
    orders = _table(spark, sf_dir, "orders")
    named = orders.select("o_orderdate", F.col("o_orderkey").alias("update_key"), "o_custkey")
    return ts.temporal_profile(named, by_name=True)


@query("SELECT least(5, count(*)) AS rows_found FROM events")
def sample_rows(spark, sf_dir):
    """Sampled rows that the table holds: all of them."""
    events = _table(spark, sf_dir, "events")
    sample = ts.sample_rows(events.select("event_id", "ts"), 5)
    found = events.join(F.broadcast(sample), ["event_id", "ts"], "left_semi")
    return found.agg(F.count(F.lit(1)).alias("rows_found"))


@query(
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, substr(lang, 1, 100) AS lang, "
    "substr(text, 1, 100) AS text FROM documents ORDER BY n_chars DESC, doc_id DESC LIMIT 5"
)
def preview(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    longest = ts.recent_records(documents, "n_chars", 5, ["doc_id"])
    return ts.preview(longest.select("doc_id", "lang", "text"))


# Sources and sinks


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def parquet_view(spark, sf_dir):
    ts.parquet_view(spark, "imported_orders", f"{sf_dir}/orders.parquet")
    return spark.sql("SELECT o_orderstatus, count(*) AS n FROM imported_orders GROUP BY 1")


@query("SELECT * FROM events")
def export_roundtrip(spark, sf_dir):
    export = _export(spark, sf_dir, "events", order_by="ts", tie_break=["event_id"])
    return spark.read.parquet(export.path)


@query("SELECT * FROM lineitem")
def export_multi_file(spark, sf_dir):
    export = _export(spark, sf_dir, "lineitem", order_by="l_shipdate", rows_per_file=10_000)
    return spark.read.parquet(export.path)


@query("SELECT * FROM documents")
def export_unordered(spark, sf_dir):
    return spark.read.parquet(_export(spark, sf_dir, "documents").path)


@query(
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders "
    "WHERE o_orderstatus = 'F' AND o_totalprice > 1000"
)
def export_query(spark, sf_dir):
    ts.parquet_view(spark, "exported_orders", f"{sf_dir}/orders.parquet")
    source = ts.resolve_source(
        spark,
        sql="SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM exported_orders "
        "WHERE o_orderstatus = 'F' AND o_totalprice > 1000",
    )
    export = ts.export_dataset(
        source,
        fresh_folder(spark, "export"),
        "orders_query",
        order_by="o_orderdate",
        tie_break=["o_orderkey"],
    )
    return spark.read.parquet(export.path)


@query("SELECT * FROM supplier")
def export_table(spark, sf_dir):
    """The source is a catalog table."""
    table = _table_name("exported")
    ts.publish_table(spark, table, path=f"{sf_dir}/supplier.parquet")
    source = ts.resolve_source(spark, table=table)
    export = ts.export_dataset(source, fresh_folder(spark, "export"), "supplier")
    return spark.read.parquet(export.path)


@query(
    "SELECT CAST(greatest(1, count(*) // 1000) AS BIGINT) AS planned_files, "
    "CAST(greatest(1, count(*) // 1000) AS BIGINT) AS files, count(*) AS row_count FROM lineitem"
)
def export_unordered_files(spark, sf_dir):
    """Without an order, too, the files are as many as the rule says."""
    export = _export(spark, sf_dir, "lineitem", rows_per_file=1_000)
    found = ts.file_rows(spark, export.path).agg(
        F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("row_count")
    )
    return found.select(
        F.lit(export.planned_files).cast("bigint").alias("planned_files"), "files", "row_count"
    )


@query(
    "SELECT CAST(greatest(1, count(*) // 10000) AS BIGINT) AS files, "
    "CAST(greatest(1, count(*) // 10000) AS BIGINT) AS parquet_names, "
    "CAST(greatest(1, count(*) // 10000) AS BIGINT) AS same_as_path FROM lineitem"
)
def file_names(spark, sf_dir):
    export = _export(spark, sf_dir, "lineitem", order_by="l_shipdate", rows_per_file=10_000)
    manifest = ts.file_manifest(spark, f"{export.path}/")
    return manifest.agg(
        F.count_distinct("file_name").alias("files"),
        F.count_if(F.endswith("file_name", F.lit(".parquet"))).alias("parquet_names"),
        F.count_if(F.col("file_name") == F.col("rel_path")).alias("same_as_path"),
    )


@query("SELECT * FROM embeddings")
def export_nested(spark, sf_dir):
    return spark.read.parquet(_export(spark, sf_dir, "embeddings", order_by="vec_id").path)


@query(
    "SELECT count(*) AS row_count, CAST(11 AS BIGINT) AS column_count, "
    "CAST(greatest(1, count(*) // 10000) AS BIGINT) AS file_count, true AS has_bytes FROM lineitem"
)
def export_summary(spark, sf_dir):
    export = _export(spark, sf_dir, "lineitem", order_by="l_shipdate", rows_per_file=10_000)
    return ts.export_summary(spark, export).select(
        "row_count", "column_count", "file_count", (F.col("total_bytes") > 0).alias("has_bytes")
    )


@query(
    "SELECT CAST(greatest(1, count(*) // 10000) AS BIGINT) AS file_count, true AS sizes_match, "
    "true AS means_match FROM lineitem"
)
def file_stats(spark, sf_dir):
    """Statistics of an export against the bytes its files really hold."""
    export = _export(spark, sf_dir, "lineitem", order_by="l_shipdate", rows_per_file=10_000)
    stats = ts.file_stats(ts.file_manifest(spark, export.path))
    content = spark.read.format("binaryFile").load(export.path)
    read = content.agg(F.sum(F.octet_length("content")).alias("content_bytes"))
    return stats.unionByName(read, allowMissingColumns=True).agg(
        F.max("file_count").alias("file_count"),
        (F.max("total_bytes") == F.max("content_bytes")).alias("sizes_match"),
        (F.round(F.max("mean_mb") * F.max("file_count"), 6) == F.round(F.max("total_mb"), 6)).alias(
            "means_match"
        ),
    )


@query(
    "SELECT CAST(greatest(1, count(*) // 10000) AS BIGINT) AS files, count(*) AS rows_in_files, "
    "CAST(1 AS BIGINT) AS versions FROM lineitem"
)
def file_manifest(spark, sf_dir):
    """Manifest with rows per file, summed up."""
    export = _export(spark, sf_dir, "lineitem", order_by="l_shipdate", rows_per_file=10_000)
    return ts.file_rows(spark, export.path).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("row_count").alias("rows_in_files"),
        F.count_distinct("version").alias("versions"),
    )


@query("SELECT * FROM customer")
def transfer_rewrite(spark, sf_dir):
    export = _export(spark, sf_dir, "customer")
    return ts.transfer_dataset(spark, export.path, fresh_folder(spark, "copy"), mode="rewrite")


@query(
    "SELECT CAST(greatest(1, count(*) // 10000) AS BIGINT) AS total_files, "
    "CAST(greatest(1, count(*) // 10000) AS BIGINT) AS copied, true AS complete FROM lineitem"
)
def transfer_files(spark, sf_dir):
    export = _export(spark, sf_dir, "lineitem", order_by="l_shipdate", rows_per_file=10_000)
    outcomes = ts.transfer_dataset(spark, export.path, fresh_folder(spark, "copy"), mode="files")
    return ts.transfer_summary(outcomes).drop("total_bytes")


@query(
    "SELECT CAST(greatest(1, count(*) // 10000) AS BIGINT) AS total_files, true AS complete, "
    "CAST(greatest(1, count(*) // 10000) - 1 AS BIGINT) AS reused_files FROM lineitem"
)
def transfer_resumed(spark, sf_dir):
    """A copy that lost a file afterwards and is resumed: the others are found to be there."""
    export = _export(spark, sf_dir, "lineitem", order_by="l_shipdate", rows_per_file=10_000)
    copy = fresh_folder(spark, "copy")
    ts.copy_files(spark, export.path, copy)
    lost = ts.file_manifest(spark, copy).orderBy("rel_path").first()["path"]
    os.remove(plain_path(lost))
    resumed = ts.copy_files(spark, export.path, copy, resume=True)
    return resumed.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.bool_and("ok").alias("complete"),
        F.count_if(F.col("reused") == F.col("chunks")).alias("reused_files"),
    )


@query("SELECT * FROM pages")
def transfer_files_content(spark, sf_dir):
    """Rows read from a byte copy, in chunks far smaller than the files."""
    export = _export(spark, sf_dir, "pages")
    copy = fresh_folder(spark, "copy")
    ts.copy_files(spark, export.path, copy, split_bytes=100_000)
    return spark.read.parquet(copy)


@query("SELECT 'same' AS status, CAST(greatest(1, count(*) // 10000) AS BIGINT) AS files FROM lineitem")
def compare_manifests(spark, sf_dir):
    export = _export(spark, sf_dir, "lineitem", order_by="l_shipdate", rows_per_file=10_000)
    copy = fresh_folder(spark, "copy")
    ts.copy_files(spark, export.path, copy)
    outcome = ts.compare_manifests(
        ts.file_manifest(spark, export.path), ts.file_manifest(spark, copy)
    )
    return outcome.groupBy("status").agg(F.count(F.lit(1)).alias("files"))


@query(
    "SELECT 'same' AS status, CAST(greatest(1, count(*) // 1000) - 2 AS BIGINT) AS files "
    "FROM lineitem UNION ALL SELECT 'missing', count(*) FROM region WHERE r_regionkey = 0 "
    "UNION ALL SELECT 'resized', count(*) FROM region WHERE r_regionkey = 1 "
    "UNION ALL SELECT 'extra', count(*) FROM region WHERE r_regionkey = 2"
)
def compare_manifests_damaged(spark, sf_dir):
    """The manifest of a copy in which one file is gone, one shorter and one too many."""
    export = _export(spark, sf_dir, "lineitem", order_by="l_shipdate", rows_per_file=1_000)
    manifest = ts.file_manifest(spark, export.path)
    # A task writes several files, so numbers of tasks do not tell them apart.
    gone, shorter = (r["rel_path"] for r in manifest.orderBy("rel_path").limit(2).collect())
    cut = F.when(F.col("rel_path") == shorter, F.col("length") - 1).otherwise(F.col("length"))
    copy = manifest.where(F.col("rel_path") != gone).withColumn("length", cut)
    added = manifest.where(F.col("rel_path") == gone).withColumn(
        "rel_path", F.lit("left-over.parquet")
    )
    outcome = ts.compare_manifests(manifest, copy.unionByName(added))
    return outcome.groupBy("status").agg(F.count(F.lit(1)).alias("files"))


@query("SELECT lpad(CAST(o_orderkey % 3 AS VARCHAR), 3, '0') AS part, count(*) AS n FROM orders GROUP BY 1")
def transfer_partitioned(spark, sf_dir):
    """A dataset in partition folders, whose values look like numbers but are text."""
    orders = _table(spark, sf_dir, "orders")
    part = F.lpad((F.col("o_orderkey") % 3).cast("string"), 3, "0")
    folder = fresh_folder(spark, "partitioned")
    orders.withColumn("part", part).write.partitionBy("part").parquet(folder)
    copy = ts.transfer_dataset(spark, folder, fresh_folder(spark, "copy"))
    return copy.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT * FROM orders")
def publish_over_other_format(spark, sf_dir):
    """A table of comma-separated files is replaced by Parquet of the same columns."""
    table, folder = _table_name("other_format"), fresh_folder(spark, "csv")
    orders = _table(spark, sf_dir, "orders")
    orders.where("o_orderstatus = 'F'").write.csv(folder)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in orders.schema)
    spark.sql("CREATE SCHEMA IF NOT EXISTS tableship_queries")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING CSV LOCATION '{folder}'")
    ts.publish_table(spark, table, frame=orders, root=fresh_folder(spark, "tables"))
    return spark.table(table)


@query("SELECT count(*) AS row_count, count(DISTINCT c_custkey) AS customers FROM customer")
def publish_unvalidated(spark, sf_dir):
    """Published without looking for rows first; the count is taken afterwards."""
    table = _table_name("unvalidated")
    path = f"{sf_dir}/customer.parquet"
    ts.publish_table(spark, table, path=path, validate_source=False)
    live = ts.target_snapshot(spark, table).select("row_count")
    customers = spark.table(table).agg(F.count_distinct("c_custkey").alias("customers"))
    return live.join(F.broadcast(customers))  # one row each


@query("SELECT * FROM orders")
def publish_table(spark, sf_dir):
    table = _table_name("published")
    orders = _table(spark, sf_dir, "orders")
    ts.publish_table(spark, table, frame=orders, root=fresh_folder(spark, "tables"))
    return spark.table(table)


@query("SELECT * FROM orders")
def publish_replace(spark, sf_dir):
    """Some orders are published first, then all of them under the same name."""
    table = _table_name("replaced")
    root = fresh_folder(spark, "tables")
    orders = _table(spark, sf_dir, "orders")
    finished = orders.where("o_orderstatus = 'F'")
    ts.publish_table(spark, table, frame=finished, root=root, version="20240101_000000")
    ts.publish_table(spark, table, frame=orders, root=root, version="20240102_000000")
    return spark.table(table)


@query("SELECT true AS table_exists, count(*) AS row_count, CAST(6 AS BIGINT) AS column_count FROM orders")
def target_snapshot(spark, sf_dir):
    table = _table_name("snapshot")
    ts.publish_table(spark, table, path=f"{sf_dir}/orders.parquet")
    return ts.target_snapshot(spark, table).drop("table_name")


@query(
    "SELECT count(*) AS row_count, CAST(6 AS BIGINT) AS column_count, 'test' AS purpose, "
    "min(o_orderdate) AS o_orderdate_min, max(o_orderdate) AS o_orderdate_max FROM orders"
)
def table_info(spark, sf_dir):
    table = _table_name("info")
    path = f"{sf_dir}/orders.parquet"
    ts.publish_table(spark, table, path=path, properties={"purpose": "test"})
    return ts.table_info(spark, table).select(
        "row_count",
        "column_count",
        F.col("properties")["purpose"].alias("purpose"),
        "o_orderdate_min",
        "o_orderdate_max",
    )


# Verification


@query("SELECT count(*) AS row_count, CAST(11 AS BIGINT) AS column_count FROM lineitem")
def profile_source(spark, sf_dir):
    return ts.profile_source(_source(spark, sf_dir, "lineitem")).select(
        "row_count", "column_count"
    )


@query("SELECT count(*) AS source_rows, count(*) AS target_rows, true AS matches FROM lineitem")
def verify_export(spark, sf_dir):
    export = _export(spark, sf_dir, "lineitem", order_by="l_shipdate")
    return ts.verify_export(spark, export, _table(spark, sf_dir, "lineitem"))


@query(
    "SELECT count(*) AS source_rows, count(*) AS target_rows, true AS same_content, "
    "true AS matches FROM documents"
)
def verify_import(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    table = _table_name("imported")
    ts.publish_table(spark, table, frame=documents, root=fresh_folder(spark, "tables"))
    return ts.verify_import(documents, spark.table(table))


@query(
    "SELECT count(*) AS source_rows, count(*) AS target_rows, false AS same_content, "
    "false AS matches FROM orders"
)
def verify_import_lenient(spark, sf_dir):
    """Equal counts of changed rows, which a comparison of counts would let pass."""
    orders = _table(spark, sf_dir, "orders")
    changed = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return ts.verify_import(orders, changed, strict=False)


@query(
    "SELECT 'missing' AS status, count(*) AS n FROM orders WHERE o_orderstatus = 'P' "
    "UNION ALL SELECT 'changed', count(*) FROM orders WHERE o_orderstatus = 'O' "
    "UNION ALL SELECT 'same', count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'P')"
)
def reconcile(spark, sf_dir):
    """All orders against a copy without the pending ones and with the open ones altered."""
    orders = _table(spark, sf_dir, "orders")
    open_priority = F.when(F.col("o_orderstatus") == "O", F.lit("altered"))
    target = orders.where("o_orderstatus <> 'P'").withColumn(
        "o_orderpriority", F.coalesce(open_priority, "o_orderpriority")
    )
    return ts.reconcile(orders, target, ["o_orderkey"])


@query(
    "SELECT 'missing' AS status, count(*) AS n FROM "
    "(SELECT * FROM lineitem EXCEPT ALL SELECT * FROM lineitem WHERE l_returnflag <> 'R') t "
    "UNION ALL SELECT 'same', count(*) FROM lineitem WHERE l_returnflag <> 'R'"
)
def reconcile_rows(spark, sf_dir):
    """Line items, which have no unique key, against those not returned."""
    lineitem = _table(spark, sf_dir, "lineitem")
    return ts.reconcile(lineitem, lineitem.where("l_returnflag <> 'R'"))


@query("SELECT 'same' AS status, count(*) AS n FROM lineitem")
def reconcile_equal(spark, sf_dir):
    """Line items against their export, which holds the same rows in another order."""
    export = _export(spark, sf_dir, "lineitem", order_by="l_shipdate")
    return ts.reconcile(_table(spark, sf_dir, "lineitem"), spark.read.parquet(export.path))


@query(
    "SELECT o_orderkey, CAST(1 AS BIGINT) AS in_source, "
    "CAST(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS BIGINT) AS in_target, "
    "CASE WHEN o_orderstatus = 'P' THEN 'missing' ELSE 'changed' END AS status "
    "FROM orders WHERE o_orderstatus = 'P' OR o_totalprice > 9000"
)
def key_differences(spark, sf_dir):
    """Orders left out of a copy, and orders whose price was altered in it."""
    orders = _table(spark, sf_dir, "orders")
    altered = F.when(F.col("o_totalprice") > 9000, 0.0).otherwise(F.col("o_totalprice"))
    target = orders.where("o_orderstatus <> 'P'").withColumn("o_totalprice", altered)
    return ts.key_differences(orders, target, ["o_orderkey"])


@query(
    "SELECT o_orderkey, CAST(1 AS BIGINT) AS in_source, "
    "CAST(CASE WHEN day(o_orderdate) = 7 THEN 0 ELSE 1 END AS BIGINT) AS in_target, "
    "CASE WHEN day(o_orderdate) = 7 THEN 'missing' ELSE 'changed' END AS status "
    "FROM orders WHERE day(o_orderdate) IN (7, 21)"
)
def key_differences_sketch(spark, sf_dir):
    """Orders of two days of each month, lost or altered in a copy: changes all over the table,
    decoded from a sketch."""
    orders = _table(spark, sf_dir, "orders")
    altered = F.when(F.day("o_orderdate") == 21, -1.0).otherwise(F.col("o_totalprice"))
    target = orders.where(F.day("o_orderdate") != 7).withColumn("o_totalprice", altered)
    return ts.key_differences(orders, target, ["o_orderkey"], sketch_bits=14)


@query(
    "SELECT 'missing' AS status, count(*) AS n FROM lineitem WHERE day(l_shipdate) = 7 "
    "UNION ALL SELECT 'same', count(*) FROM lineitem WHERE day(l_shipdate) <> 7"
)
def reconcile_sketch(spark, sf_dir):
    """Line items against a copy that lost one day of each month, as bags, from a sketch."""
    lineitem = _table(spark, sf_dir, "lineitem")
    return ts.reconcile(lineitem, lineitem.where(F.day("l_shipdate") != 7), sketch_bits=14)


@query(
    "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem "
    "GROUP BY 1, 2 HAVING count(*) > 1"
)
def duplicate_keys(spark, sf_dir):
    return ts.duplicate_keys(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_REPORT = (
    "SELECT 'row_count' AS check_name, count(*) > 0 AS passed FROM {t} "
    "UNION ALL SELECT 'table_schema', count(*) = {columns} FROM information_schema.columns "
    "WHERE table_name = 'events' "
    "UNION ALL SELECT 'recent_records', max(ts) IS NOT NULL FROM {t} "
    "UNION ALL SELECT 'date_range', min(ts) IS NOT NULL FROM {t} "
    "UNION ALL SELECT 'date_distribution', count(ts) = count(*) FROM {t} "
    "UNION ALL SELECT 'unique_ids', count(DISTINCT event_id) = count(*) FROM {t} "
)


@query(_REPORT.format(t="events", columns=6))
def verification_report(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    return ts.verification_report(events, "ts", id_column="event_id").drop("detail")


@query(
    "SELECT 'row_count' AS check_name, count(*) > 0 AS passed FROM orders "
    "UNION ALL SELECT 'table_schema', count(*) > 0 FROM orders "
    "UNION ALL SELECT 'recent_records', count(*) > 0 FROM orders "
    "UNION ALL SELECT 'date_range', min(o_orderdate) IS NOT NULL FROM orders "
    "UNION ALL SELECT 'date_distribution', count(o_orderdate) = count(*) FROM orders "
    "UNION ALL SELECT 'unique_ids', count(DISTINCT o_custkey) = count(*) FROM orders"
)
def verification_report_failing(spark, sf_dir):
    """A report in which one check fails: customers recur among the orders."""
    orders = _table(spark, sf_dir, "orders")
    return ts.verification_report(orders, "o_orderdate", id_column="o_custkey").drop("detail")


@query(
    _REPORT.format(
        t="(SELECT event_id, CASE WHEN event_id % 2 = 0 THEN ts END AS ts FROM events) e", columns=6
    )
)
def verification_report_null_times(spark, sf_dir):
    """Half of the rows have no time, so the days do not add up."""
    events = _table(spark, sf_dir, "events")
    some = events.withColumn("ts", F.when(F.col("event_id") % 2 == 0, F.col("ts")))
    return ts.verification_report(some, "ts", id_column="event_id").drop("detail")


@query(_REPORT.format(t="events", columns=5))
def verification_report_types(spark, sf_dir):
    """The names are right and one type is not."""
    events = _table(spark, sf_dir, "events")
    text = events.withColumn("user_id", F.col("user_id").cast("string"))
    return ts.verification_report(
        text, "ts", id_column="event_id", expected_columns=events.columns,
        expected_schema=events.schema,
    ).drop("detail")


@query(
    "SELECT 'row_count' AS check_name, count(*) > 0 AS passed FROM events "
    "UNION ALL SELECT 'table_schema', count(*) > 0 FROM events "
    "UNION ALL SELECT n, count(*) < 0 FROM events, (VALUES ('recent_records'), ('date_range'), "
    "('date_distribution')) AS v(n) GROUP BY n "
    "UNION ALL SELECT 'unique_ids', count(DISTINCT event_id) = count(*) FROM events"
)
def verification_report_errors(spark, sf_dir):
    """A time column that is not there: three checks end in an error, the others go on."""
    events = _table(spark, sf_dir, "events")
    return ts.verification_report(events, "no_such_time", id_column="event_id").drop("detail")


@query(
    "SELECT 'row_count' AS check_name, format('{:,} rows', count(*)) AS detail FROM lineitem "
    "UNION ALL SELECT 'date_distribution', "
    "format('{:,} of {:,} rows have a day', count(l_shipdate), count(*)) FROM lineitem"
)
def report_detail(spark, sf_dir):
    """Numbers in details have separators for thousands."""
    report = ts.verification_report(_table(spark, sf_dir, "lineitem"), "l_shipdate")
    return report.where("check_name IN ('row_count', 'date_distribution')").select(
        "check_name", "detail"
    )


@query("SELECT * FROM events")
def migrate_failed_keeps_live(spark, sf_dir):
    """A strict run under the version of the live table fails and leaves its rows."""
    first = migrate_events(spark, sf_dir)
    repeated = _table(spark, sf_dir, "events").where("event_id % 2 = 0")
    root = first.location.rsplit("/imports/", 1)[0]
    try:
        ts.migrate(
            spark,
            ts.resolve_source(spark, frame=repeated.unionByName(repeated)),
            f"{root}/exports",
            f"{root}/imports",
            "events",
            first.table,
            time_column="ts",
            id_column="event_id",
            version=first.export.version,
        )
    except Exception as error:  # which one is for the tests; here the rows matter
        if not str(error):
            raise
    return spark.table(first.table)


@query(
    _REPORT.format(t="events", columns=6)
    + "UNION ALL SELECT 'content', count(*) > 0 FROM events "
    "UNION ALL SELECT 'published', count(*) > 0 FROM events"
)
def migrate(spark, sf_dir):
    return migrate_events(spark, sf_dir).report.drop("detail")


@query("SELECT * FROM orders")
def migrate_resumed(spark, sf_dir):
    """A migration that finds a view under the name of its table, and goes on once it is gone."""
    root = fresh_folder(spark, "migration")
    version, table = new_version(), _table_name("orders")
    source = _source(spark, sf_dir, "orders")
    roots = (f"{root}/exports", f"{root}/imports", "orders", table)
    options = {"time_column": "o_orderdate", "id_column": "o_orderkey"}
    ensure_namespace(spark, table)
    spark.sql(f"CREATE VIEW {table} AS SELECT 1 AS one")
    try:
        ts.migrate(spark, source, *roots, version=version, **options)
    except ValueError:
        spark.sql(f"DROP VIEW {table}")
    return spark.table(ts.migrate(spark, source, *roots, resume=version, **options).table)


@query("SELECT * FROM events")
def migrated_table(spark, sf_dir):
    return spark.table(migrate_events(spark, sf_dir).table)


def migrate_events(spark: SparkSession, sf_dir: str) -> ts.Migration:
    root = fresh_folder(spark, "migration")
    return ts.migrate(
        spark,
        _source(spark, sf_dir, "events"),
        f"{root}/exports",
        f"{root}/imports",
        "events",
        _table_name("events"),
        time_column="ts",
        id_column="event_id",
        version=new_version(),
    )
