"""Keep predicates above multi-stage rule projections.

The rule sets are evaluated in stacked projections, where later stages refer
to earlier results several times.  A filter written on their outputs would be
pushed down through every projection with each stage's expression substituted
into it, so its size multiplies with every stage.  Columns produced by a
generator are never pushed below it, so the outputs are re-emitted through a
one-row ``explode``: filters stay on top, everything else is unchanged.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fence(df: DataFrame, derived: Sequence[str]) -> DataFrame:
    """Return ``df`` (same columns, same order) with the ``derived`` columns
    passed through a one-element explode."""
    derived = [c for c in df.columns if c in set(derived)]
    if not derived:
        return df
    others = [c for c in df.columns if c not in set(derived)]
    packed = df.select(*[F.col(f"`{c}`") for c in others],
                       F.explode(F.array(F.struct(*[F.col(f"`{c}`") for c in derived]))).alias("__fenced"))
    return packed.select(*[F.col(f"`{c}`") if c in others else F.col("__fenced").getField(c).alias(c)
                           for c in df.columns])
