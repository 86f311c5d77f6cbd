"""Materialised intermediate tables."""
from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import land


def materialize(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder (see ``session.shared_folder``)."""
    return land(df)
