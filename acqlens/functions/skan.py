"""Privacy postback (SKAN) conversion-value helpers."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Conversion-value bands (inclusive bounds) and the valid 6-bit range.
CV_BANDS = ("unknown", "none", "low", "medium", "high")
CV_LOW = (1, 15)
CV_MEDIUM = (16, 39)
CV_MIN, CV_MAX = 0, 63
CONVERSION_BANDS = ("low", "medium", "high")
# Fixed value: postbacks per campaign below which the value is withheld (crowd anonymity).
K_ANONYMITY_THRESHOLD = 15


def cv_band(cv: Column | str) -> Column:
    c = F.col(cv) if isinstance(cv, str) else cv
    return (F.when(c.isNull(), "unknown")
            .when(c == 0, "none")
            .when(c.between(*CV_LOW), "low")
            .when(c.between(*CV_MEDIUM), "medium")
            .otherwise("high"))


def is_crowd_anonymized(cv: Column | str) -> Column:
    c = F.col(cv) if isinstance(cv, str) else cv
    return F.when(c.isNull(), 1).otherwise(0)
