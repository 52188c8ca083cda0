"""Native column-expression helpers: JSON handling and timestamp text."""

from zonelake.functions.json import (  # noqa: F401
    canonical_json,
    field,
    fingerprint,
    has_field,
    is_number,
    kind,
    py_type_name,
    py_type_name_of_kind,
    strict_json,
    top_kind,
    variant_string,
)
from zonelake.functions.pytext import json_string, py_json, py_str  # noqa: F401
from zonelake.functions.time import (  # noqa: F401
    hour_floor,
    is_python_isoformat,
    iso_text,
    parse_date,
    parse_ts,
    raw_key,
    raw_partition_values,
)
from zonelake.functions.util import as_col, ts_literal  # noqa: F401
