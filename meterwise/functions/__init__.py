from meterwise.functions.columns import (  # noqa: F401
    duration_sec,
    month_start,
    ntz,
    parse_ts,
    pg_initcap,
    record_hash,
    row_hash,
    row_json,
    session_bucket,
)
