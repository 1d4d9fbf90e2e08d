"""Readers: by-name multi-file CSV, typed scans, bad-line skipping, manifests, audits."""

from fundflow.sources.incremental import Gathered, delete_folder, gather_years  # noqa: F401
from fundflow.sources.manifest import (  # noqa: F401
    escape_glob, file_heads, file_table, list_files, source_file, year_from_name,
)
from fundflow.sources.readers import (  # noqa: F401
    all_string_schema, bad_cast, bad_cast_counts, files_for_years, ingest_audit, missing_sources, read_csv_text, read_manifest,
    read_many, read_parquet_many, read_tolerant, stage_lines, typed,
)
from fundflow.sources.schemas import ABATEMENT_TYPES, RATE_TYPES, TIF_TYPES  # noqa: F401
