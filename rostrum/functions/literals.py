"""Constant lists and maps as single literal expressions, built once per session.

``col.isin(*values)`` and ``create_map(lit, lit, ...)`` cost one driver->JVM
call per element while a query is being built; the rule sets use the same
word lists many times.  These helpers parse each constant once with
``F.expr`` and reuse the Column (a plain literal: Catalyst constant-folds it).
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_CACHE: dict = {}
_OWNER: list = [None]       # the session whose literals are kept


def _sql_str(s: str) -> str:
    return "'" + str(s).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _key(*parts):
    # a Column belongs to the JVM that built it: another session starts the cache anew
    session = SparkSession.getActiveSession()
    if _OWNER[0] is not session:
        _CACHE.clear()
        _OWNER[0] = session
    return parts


def str_array(values: Iterable[str]) -> Column:
    """array<string> literal of ``values`` (cached)."""
    vals = tuple(values)
    k = _key("arr", vals)
    if k not in _CACHE:
        _CACHE[k] = F.expr("array(" + ", ".join(_sql_str(v) for v in vals) + ")") if vals \
            else F.array().cast("array<string>")
    return _CACHE[k]


def in_list(c: Column, values: Iterable[str]) -> Column:
    """``c IN (values)`` for a constant string list (NULL when ``c`` is NULL)."""
    return F.array_contains(str_array(values), c)


def str_map(pairs: Mapping[str, str]) -> Column:
    """map<string,string> literal (cached)."""
    items = tuple(pairs.items())
    k = _key("map", items)
    if k not in _CACHE:
        _CACHE[k] = F.expr("map(" + ", ".join(f"{_sql_str(a)}, {_sql_str(b)}" for a, b in items) + ")")
    return _CACHE[k]


def empty_str() -> Column:
    k = _key("empty")
    if k not in _CACHE:
        _CACHE[k] = F.lit("")
    return _CACHE[k]
