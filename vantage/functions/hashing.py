"""Deterministic hash draws that Spark and an ANSI SQL engine compute identically.

``hash32(x)`` = first 8 hex digits of ``md5(cast(x as string))`` read as an
unsigned 32-bit integer.  The same value is ``('0x'||substr(md5(x),1,8))::BIGINT``
in DuckDB, so splits, folds, bootstrap draws and projection matrices built on it
can be checked against SQL.  ``rand()`` is never used where a result is checked.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO32 = 4294967296.0


def _key(*parts) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    if len(cols) == 1:
        return cols[0].cast("string")
    return F.concat_ws(":", *[c.cast("string") for c in cols])


def hash32(*parts) -> Column:
    """Unsigned 32-bit hash of the ':'-joined string form of ``parts``."""
    return F.conv(F.substring(F.md5(_key(*parts)), 1, 8), 16, 10).cast("bigint")


def hash60(*parts) -> Column:
    """Unsigned 60-bit hash (15 hex digits): for draws of positions in tables of any size."""
    return F.conv(F.substring(F.md5(_key(*parts)), 1, 15), 16, 10).cast("bigint")


def hash_unit(*parts) -> Column:
    """Uniform draw in [0, 1)."""
    return hash32(*parts) / F.lit(TWO32)


def hash_bucket(buckets: int, *parts) -> Column:
    return F.pmod(hash32(*parts), F.lit(buckets))


def py_hash32(*parts) -> int:
    """Driver-side twin of :func:`hash32` for model-sized tables (projection matrices)."""
    key = ":".join(str(p) for p in parts)
    return int(hashlib.md5(key.encode("utf-8")).hexdigest()[:8], 16)


def py_hash_unit(*parts) -> float:
    return py_hash32(*parts) / TWO32
