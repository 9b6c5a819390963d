"""Event names: attribution (MMP) names vs backend names."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event vocabulary.
INSTALL_EVENT = "install"
REVENUE_EVENTS = ("af_purchase", "af_subscribe")
BACKEND_EVENTS = ("purchase", "subscribe")
MMP_TO_BACKEND = {"af_purchase": "purchase", "af_subscribe": "subscribe"}
PLATFORMS = ("ios", "android")


def to_backend_event(name: Column | str) -> Column:
    """Map an MMP revenue event name onto the backend taxonomy; other names -> NULL."""
    c = F.col(name) if isinstance(name, str) else name
    out = None
    for mmp, backend in MMP_TO_BACKEND.items():
        out = F.when(c == mmp, backend) if out is None else out.when(c == mmp, backend)
    return out
