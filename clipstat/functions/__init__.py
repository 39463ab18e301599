"""Column-expression functions (all JVM-side built-ins, no Python UDFs)."""

from clipstat.functions.durations import (  # noqa: F401
    iso8601_to_seconds, seconds_to_iso8601, seconds_to_readable, readable_to_seconds,
)
from clipstat.functions.columns import (  # noqa: F401
    count_from_text, null_safe_count, content_type, is_short, engagement_ratio,
    parse_published_at, parse_extraction_date, strip_handle,
)
