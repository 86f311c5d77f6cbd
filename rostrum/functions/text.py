"""Python-equivalent string primitives as Spark Column expressions.

The reference cleans text with Python ``str`` methods and ``re``; Spark's
built-ins differ in small ways (``trim`` only removes spaces, ``split`` keeps a
leading empty token, ``regexp_extract`` returns '' on a miss, ``round`` is
half-up).  The helpers below close those gaps once so every rule set can use
them. ``py_round`` is Python's ``round`` (half-even on the binary value; ``F.bround``
rounds the shortest decimal text).
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One number: integer or decimal (used by all age profiles).
NUM = r"(\d+(?:\.\d+)?)"


def pstrip(c: Column) -> Column:
    """``str.strip()``: remove leading/trailing whitespace, Unicode-aware."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squash_ws(c: Column) -> Column:
    """``re.sub(r"\\s+", " ", s)``."""
    return F.regexp_replace(c, r"(?U)\s+", " ")


def find_all(c: Column, pattern: str, idx: int = 0) -> Column:
    """``re.findall``: array of all non-overlapping matches (group ``idx``)."""
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(idx))


def count_matches(c: Column, pattern: str) -> Column:
    return F.size(find_all(F.coalesce(c, F.lit("")), pattern, 0))


def nums_array(c: Column, pattern: str = r"\d+(?:\.\d+)?") -> Column:
    """All numbers in ``c`` as array<double>."""
    return F.transform(find_all(F.coalesce(c, F.lit("")), pattern, 0),
                       lambda x: x.try_cast("double"))


def capitalize(c: Column) -> Column:
    """``str.capitalize()``: first character upper, the rest lower."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def strip_chars(c: Column, chars: str) -> Column:
    """``str.strip(chars)`` for a set of literal characters."""
    cls = "".join("\\" + ch if ch in r"\^-]." else ch for ch in chars)
    return F.regexp_replace(c, f"^[{cls}]+|[{cls}]+$", "")


_SPLIT = 134217729.0  # 2**27 + 1 (Veltkamp split of a double into two 26-bit halves)


def _split_const(v: float) -> tuple[float, float]:
    c = _SPLIT * v
    hi = c - (c - v)
    return hi, v - hi


def py_round(x: Column, ndigits: int) -> Column:
    """Python's ``round(x, n)`` for doubles: half-even rounding of the *exact*
    binary value (``round(129.515, 2) == 129.51`` because 129.515 is stored as
    129.51499...).  ``F.bround`` rounds the shortest decimal text instead and
    would give 129.52.

    p = x * 10**n is computed with its exact rounding error (Dekker's
    error-free product); the error only matters when p lands exactly on a half.
    ``x`` should be a column reference (it is used several times)."""
    f = 10.0 ** ndigits
    bh, bl = _split_const(f)
    p = x * F.lit(f)
    c = x * F.lit(_SPLIT)
    ah = c - (c - x)
    al = x - ah
    err = ((ah * F.lit(bh) - p) + ah * F.lit(bl) + al * F.lit(bh)) + al * F.lit(bl)
    fl = F.floor(p).cast("double")
    tie = (p - fl) == F.lit(0.5)
    k = F.when(tie, F.when(err > 0, fl + 1).when(err < 0, fl).when(fl % 2 == 0, fl).otherwise(fl + 1)) \
        .otherwise(F.rint(p))
    return k / F.lit(f)
