"""pulsegrid — device-telemetry analytics on Spark.

Operators are DataFrame → DataFrame functions (``pulsegrid.operators``);
sources, sinks and streaming jobs wrap them; ``pulsegrid.plans`` holds the
query catalogue used by ``__spark_entry__.py``.
"""

from .options import DEFAULT, Options
from .operators.parse import parse_health
from .operators.windows import all_windows, blood_pressure_windows, blood_sugar_windows, heart_rate_windows
from .operators.alerts import alert_rows, metric_rows
from .operators.anchored import anchored_windows

__all__ = [
    "DEFAULT",
    "Options",
    "parse_health",
    "heart_rate_windows",
    "blood_pressure_windows",
    "blood_sugar_windows",
    "all_windows",
    "metric_rows",
    "alert_rows",
    "anchored_windows",
]
