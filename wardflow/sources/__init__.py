"""Raw table contracts, readers and lookup rows."""

from wardflow.sources.readers import (  # noqa: F401
    Sources,
    conform,
    read_csv,
    read_parquet,
    sources_from_catalog,
    sources_from_files,
)
from wardflow.sources.reference_rows import condition_rows, provider_type_codes  # noqa: F401
