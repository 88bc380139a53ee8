from lendmill.operators.applications import enrich_applications
from lendmill.operators.messages import flatten_messages, pack_messages, synth_applications, synth_messages
from lendmill.operators.metrics import (
    application_metrics,
    count_by,
    histogram,
    mean_by,
    overall_stats,
    share_by,
)
from lendmill.operators.rows import ordered_head, ordered_range, require_key, stamp, stored_head
from lendmill.operators.upsert import upsert_by_key

__all__ = [
    "application_metrics",
    "count_by",
    "enrich_applications",
    "flatten_messages",
    "histogram",
    "mean_by",
    "ordered_head",
    "ordered_range",
    "overall_stats",
    "pack_messages",
    "require_key",
    "share_by",
    "stamp",
    "stored_head",
    "synth_applications",
    "synth_messages",
    "upsert_by_key",
]
