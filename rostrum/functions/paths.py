"""Path operators (family P): path -> storage prefix, prefix listings.

The reference inspects one local path and lists one object-store prefix;
here both run over a *column* of paths so any number of paths/prefixes are
processed in parallel.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mount point and folder markers, in rule order.
MOUNT = "/home/airflow/gcs"
DAGS_MARKER = "/dags/"
GCS_MARKER = "/gcs/"


def normpath(p: Column) -> Column:
    """``posixpath.normpath``: empty and '.' segments dropped, '..' removes the
    previous segment (kept when nothing is left to remove on a relative path,
    dropped at the root of an absolute one), exactly two leading slashes are
    kept, three or more become one; '' -> '.'."""
    init = (F.when(p.startswith("//") & ~p.startswith("///"), F.lit("//"))
            .when(p.startswith("/"), F.lit("/")).otherwise(F.lit("")))
    absolute = p.startswith("/")

    def step(acc, comp):
        last = F.try_element_at(acc, F.lit(-1))
        keep = (comp != "..") | (~absolute & (F.size(acc) == 0)) | ((F.size(acc) > 0) & (last == ".."))
        return (F.when(comp.isin("", "."), acc)
                .when(keep, F.concat(acc, F.array(comp)))
                .when(F.size(acc) > 0, F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
                .otherwise(acc))
    comps = F.aggregate(F.split(p, "/", -1), F.array().cast("array<string>"), step)
    out = F.concat(init, F.array_join(comps, "/"))
    return F.when(out == "", F.lit(".")).otherwise(out)


def dirname(p: Column) -> Column:
    """``posixpath.dirname``: text before the last '/', trailing slashes
    removed unless the head is all slashes."""
    head = F.regexp_extract(p, r"^(.*/)[^/]*$", 1)
    stripped = F.regexp_replace(head, r"/+$", "")
    return F.when(head == "", F.lit("")).when(stripped == "", head).otherwise(stripped)


def _with_slash(d: Column) -> Column:
    return F.when(d.endswith("/"), d).otherwise(F.concat(d, F.lit("/")))


def storage_prefix(path: Column) -> Column:
    """Object-store prefix of a local path, always ending with '/':
    after the mount point, else from 'dags/', else from 'gcs/', else the
    path's own directory."""
    p = normpath(path)
    after_mount = F.substr(p, F.lit(len(MOUNT) + 2))
    i_dags = F.instr(p, DAGS_MARKER)
    i_gcs = F.instr(p, GCS_MARKER)
    from_dags = F.substr(p, i_dags + 1)
    from_gcs = F.substr(p, i_gcs + 1)
    return (F.when(p.startswith(MOUNT), _with_slash(dirname(after_mount)))
            .when(i_dags > 0, _with_slash(dirname(from_dags)))
            .when(i_gcs > 0, _with_slash(dirname(from_gcs)))
            .otherwise(_with_slash(dirname(p))))


def ancestor_prefixes(path: Column) -> Column:
    """All folder prefixes of an object name: 'a/b/c' -> ['a/', 'a/b/']."""
    parts = F.split(path, "/", -1)
    n = F.size(parts)
    return F.when(n <= 1, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), n - 1),
                    lambda i: F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))))
