"""Move tables between environments on Spark and prove that the move was right."""

from tableship.functions.hashing import fingerprint, row_hash
from tableship.operators.export import Export, export_dataset, export_summary
from tableship.operators.layout import arrange_ordered, arrange_unordered, target_files
from tableship.operators.profile import (
    column_profile,
    date_distribution,
    date_range,
    footer_null_counts,
    null_counts,
    preview,
    quality_summary,
    recent_records,
    row_count,
    sample_rows,
    table_schema,
    temporal_profile,
)
from tableship.operators.publish import (
    publish_table,
    table_info,
    table_properties,
    target_snapshot,
)
from tableship.operators.reconcile import (
    duplicate_keys,
    key_differences,
    reconcile,
    reconcile_totals,
)
from tableship.operators.transfer import copy_files, transfer_dataset, transfer_summary
from tableship.plans.migrate import Migration, migrate
from tableship.plans.verify import (
    profile_source,
    verification_report,
    verify_export,
    verify_import,
)
from tableship.session import cluster_conf, get_session
from tableship.sources.footers import (
    FooterIndex,
    column_bytes,
    footer_index,
    indexed_null_counts,
    indexed_range,
    indexed_row_count,
    schema_versions,
)
from tableship.sources.manifest import compare_manifests, file_manifest, file_rows, file_stats
from tableship.sources.resolve import (
    Source,
    parquet_view,
    read_dataset,
    require_rows,
    resolve_source,
)

__all__ = [name for name in dir() if not name.startswith("_")]
