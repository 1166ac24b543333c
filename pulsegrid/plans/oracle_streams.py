"""The streamed tables must equal the batch results: same oracle SQL."""

from __future__ import annotations

from .oracle_health import SQL as _H
from .oracle_ingestion import SQL as _I
from .oracle_trends import SQL as _T

SQL = {
    "stream_metrics_1min": _H["metrics_1min"],
    "stream_metrics_10min": _H["metrics_10min"],
    "stream_alerts": _H["all_alerts"],
    "stream_health_counters": _H["health_counters"],
    "stream_anchored_alerts": _H["anchored_alerts"],
    "stream_user_sessions": _T["user_sessions"],
    "stream_multi_metric_alerts": _T["multi_metric_alerts"],
    "stream_topic_routing": _I["topic_routing"],
    "stream_history_replay": _H["metrics_1min"],
}
