"""Prefix listing over a path column (S9) and prefix detection.

``list_prefixes`` answers "which files and sub-folders sit directly under
each prefix" for any number of prefixes at once.  Instead of a
``startswith`` non-equi join (a cross product), every path emits its own
ancestor prefixes (bounded by its depth) and is equi-joined to the wanted
prefixes; the result stays in long form (one row per entry), so no group is
ever collected into one task.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import ancestor_prefixes, storage_prefix


def with_storage_prefix(df: DataFrame, path_col: str = "path", out_col: str = "prefix") -> DataFrame:
    return df.withColumn(out_col, storage_prefix(F.col(path_col)))


def list_prefixes(paths: DataFrame, prefixes: DataFrame, path_col: str = "path",
                  prefix_col: str = "prefix") -> DataFrame:
    """(prefix, entry_type in {'file','folder'}, entry): direct children of each
    prefix; '' is the root, the parent of every path."""
    above = F.array_distinct(F.concat(F.array(F.lit("")), ancestor_prefixes(F.col(path_col))))
    anc = paths.select(F.col(path_col).alias("__path"), F.explode(above).alias(prefix_col))
    hit = anc.join(prefixes.select(prefix_col).distinct(), prefix_col)
    rest = F.expr(f"substring(__path, length({prefix_col}) + 1)")
    is_file = ~rest.contains("/")
    entry = F.when(is_file, F.col("__path")).otherwise(
        F.concat(F.col(prefix_col), F.substring_index(rest, "/", 1), F.lit("/")))
    return (hit.select(prefix_col, F.when(is_file, F.lit("file")).otherwise(F.lit("folder")).alias("entry_type"),
                    entry.alias("entry"))
            .distinct())
