"""Column-level functions (pure expressions, no UDFs)."""

from tidemark.functions.columns import (  # noqa: F401
    ACTIVITY_COLUMNS,
    DQ_RULES,
    MOMENTUM_WEIGHTS,
    event_bucket,
    file_hour,
    file_instant,
    hour_boundaries,
    hour_file_name,
    hour_partition_key,
    is_bot,
    minute_of,
    momentum_score,
    partition_key_to_file,
    safe_ratio,
    sla_class,
    surrogate_key,
)
