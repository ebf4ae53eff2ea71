"""Scalar column expressions shared by the operators.

All of them are built from ``pyspark.sql.functions``, so they compile into the
surrounding whole-stage-codegen span; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the studied pipeline's for equal results).
# Event types that score, and their momentum weights:
#   PushEvent 1, PullRequestEvent 4, PullRequestReviewEvent 3,
#   IssuesEvent 2, ForkEvent 2, WatchEvent 1.
# Daily activity column per scored type:
#   push_events PushEvent, pr_events PullRequestEvent, issue_events IssuesEvent,
#   star_events WatchEvent, fork_events ForkEvent,
#   review_events PullRequestReviewEvent.
# Quarantine reasons, first failing rule wins, in this order:
#   missing_event_id, missing_event_type, missing_repo_id, missing_actor_id,
#   missing_created_at.
# Events-per-repo buckets (label, ordinal): 1 -> ("1", 1), 2-3 -> ("2-3", 2),
#   4-10 -> ("4-10", 3), 11-50 -> ("11-50", 4), 51-200 -> ("51-200", 5),
#   anything else -> ("200+", 6).
# Bot accounts: login contains "[bot]", case-insensitive.
# Freshness classes on hours since the last load: null Unknown, < 24 Fresh,
#   < 48 "Stale (warn)", otherwise Breached. Source check: warn 24 h, error 48 h.
# Epoch floor for an empty incremental target: 1900-01-01 00:00:00.
# Run-ledger error text is cut to 2000 characters.
# ---------------------------------------------------------------------------
ACTIVITY_COLUMNS = [
    ("push_events", "PushEvent"),
    ("pr_events", "PullRequestEvent"),
    ("issue_events", "IssuesEvent"),
    ("star_events", "WatchEvent"),
    ("fork_events", "ForkEvent"),
    ("review_events", "PullRequestReviewEvent"),
]
MOMENTUM_WEIGHTS = {
    "push_events": 1,
    "pr_events": 4,
    "review_events": 3,
    "issue_events": 2,
    "fork_events": 2,
    "star_events": 1,
}
DQ_RULES = [
    ("event_id", "missing_event_id"),
    ("event_type", "missing_event_type"),
    ("repo_id", "missing_repo_id"),
    ("actor_id", "missing_actor_id"),
    ("created_at_utc", "missing_created_at"),
]
BUCKETS = [  # (low, high, label, ordinal); the last label is the else branch
    (1, 1, "1", 1),
    (2, 3, "2-3", 2),
    (4, 10, "4-10", 3),
    (11, 50, "11-50", 4),
    (51, 200, "51-200", 5),
]
BUCKET_ELSE = ("200+", 6)
BOT_PATTERN = "%[bot]%"
SLA_WARN_HOURS = 24
SLA_ERROR_HOURS = 48
EPOCH_FLOOR = "1900-01-01 00:00:00"
ERROR_MAX_CHARS = 2000


def surrogate_key(c: Column | str) -> Column:
    """md5 of the id rendered as text (same digest as the SQL warehouse)."""
    return F.md5(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"))


def is_bot(login: Column | str) -> Column:
    """Login contains ``[bot]``, any case; brackets are literal in LIKE."""
    c = F.col(login) if isinstance(login, str) else login
    return c.ilike(BOT_PATTERN)


def momentum_score() -> Column:
    """Weighted sum of the six activity counts, as double."""
    total = None
    for name, weight in MOMENTUM_WEIGHTS.items():
        term = F.col(name).cast("double") * F.lit(float(weight))
        total = term if total is None else total + term
    return total


def event_bucket(n: Column | str) -> tuple[Column, Column]:
    """(label, ordinal) of the events-per-repo histogram bucket."""
    c = F.col(n) if isinstance(n, str) else n
    label = F.lit(BUCKET_ELSE[0])
    ordinal = F.lit(BUCKET_ELSE[1])
    for low, high, name, o in reversed(BUCKETS):
        cond = c.between(low, high)
        label = F.when(cond, F.lit(name)).otherwise(label)
        ordinal = F.when(cond, F.lit(o)).otherwise(ordinal)
    return label, ordinal


def minute_of(ts: Column | str) -> Column:
    """Truncate to the minute, keeping the naive (NTZ) type."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_trunc("minute", c).cast("timestamp_ntz")


def hour_boundaries(start: Column, end: Column) -> Column:
    """Hour boundaries crossed from ``start`` to ``end`` (00:59 -> 01:01 is 1).

    Not elapsed hours: both ends are truncated to the hour first. Bigint.
    """
    a = F.unix_seconds(F.date_trunc("hour", start.cast("timestamp")))
    b = F.unix_seconds(F.date_trunc("hour", end.cast("timestamp")))
    return ((b - a) / F.lit(3600)).cast("bigint")


def safe_ratio(num: Column, den: Column, scale: float = 1.0) -> Column:
    """``scale * num / den`` in double, 0 when the denominator is 0 or null."""
    n = num.cast("double")
    d = den.cast("double")
    value = (F.lit(scale) * n / d) if scale != 1.0 else (n / d)
    return F.when(d > 0, value).otherwise(F.lit(0.0))


def sla_class(hours: Column) -> Column:
    return (
        F.when(hours.isNull(), F.lit("Unknown"))
        .when(hours < SLA_WARN_HOURS, F.lit("Fresh"))
        .when(hours < SLA_ERROR_HOURS, F.lit("Stale (warn)"))
        .otherwise(F.lit("Breached"))
    )


def hour_file_name(ts: Column) -> Column:
    """Hour file name of an instant: ``2024-01-15-5.json.gz`` (hour not padded)."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd-H"), F.lit(".json.gz"))


def hour_partition_key(ts: Column) -> Column:
    """Scheduler-style hour key ``2024-01-15-05:00``."""
    return F.date_format(ts, "yyyy-MM-dd-HH:mm")


def partition_key_to_file(key: Column) -> Column:
    """``2024-01-15-05:00`` -> ``2024-01-15-5.json.gz``."""
    ts = F.to_timestamp_ntz(key, F.lit("yyyy-MM-dd-HH:mm"))
    return hour_file_name(ts)


def file_hour(source_file: Column | str) -> Column:
    """Hour of day parsed from an hour file name (int), null when absent.

    File names are not zero-padded, so ``...-10`` sorts before ``...-5`` as
    text; compare this number instead.
    """
    c = F.col(source_file) if isinstance(source_file, str) else source_file
    raw = F.regexp_extract(c, r"-(\d{1,2})\.json(\.gz)?$", 1)
    return F.when(raw != "", raw.cast("int"))


def file_instant(source_file: Column | str) -> Column:
    """Start of the hour named by an hour file (naive UTC), null when absent."""
    c = F.col(source_file) if isinstance(source_file, str) else source_file
    day = F.regexp_extract(c, r"^(\d{4}-\d{2}-\d{2})-\d{1,2}\.json", 1)
    return F.when(
        (day != "") & file_hour(c).isNotNull(),
        F.to_timestamp_ntz(F.concat(day, F.lit(" "), F.lpad(file_hour(c).cast("string"), 2, "0")),
                           F.lit("yyyy-MM-dd HH")),
    )
