"""Scans and sinks."""

from creatorlens.sources.readers import (  # noqa: F401
    read_influencers, read_features_csv, read_post_files, read_json_documents, read_table, table_path,
)
from creatorlens.sources.sinks import as_records, write_csv, write_parquet, write_user_folders  # noqa: F401
