"""Column expressions (all JVM-side, codegen-friendly; no Python UDFs)."""

from revenue_engine.functions.parsing import (  # noqa: F401
    DATE_LAYOUTS, AMOUNT_PATTERN, parse_date, parse_amount, reject_reason,
)
from revenue_engine.functions.payload import raw_payload_json, sorted_map  # noqa: F401
from revenue_engine.functions.identity import revenue_id, file_key  # noqa: F401
from revenue_engine.functions.paths import landing_path, path_file_date, path_source_name  # noqa: F401
