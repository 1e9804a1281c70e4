"""Who sees what: column masking and row entitlement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mask_columns(df: DataFrame, policy: Mapping[str, str]) -> DataFrame:
    """``policy``: column -> ``hash`` (SHA-256), ``null``, or ``text:<constant>``."""
    for name, how in policy.items():
        kind = df.schema[name].dataType
        if how == "hash":
            masked = F.sha2(F.col(name).cast("string"), 256)
        elif how == "null":
            masked = F.lit(None).cast(kind)
        elif how.startswith("text:"):
            masked = F.lit(how[5:])
        else:
            raise ValueError(f"unknown mask {how!r}")
        df = df.withColumn(name, masked)
    return df


def row_filter(df: DataFrame, entitlements: DataFrame, on: Sequence[str], user: str) -> DataFrame:
    """Only rows whose scope the user holds. The user filter reaches the entitlement scan."""
    allowed = entitlements.where(F.col("user") == user).select(*on).distinct()
    return df.join(allowed, list(on), "left_semi")
