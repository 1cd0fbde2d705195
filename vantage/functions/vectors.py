"""Vector arithmetic on ``array<double>`` columns, expressed with higher-order functions.

All helpers return ``Column`` objects so they stay inside whole-stage codegen;
no Python runs per row.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_doubles(col) -> Column:
    """``array<float>`` (or any numeric array) -> ``array<double>``."""
    return F.transform(_c(col), lambda v: v.cast("double"))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def sq_dist(a, b) -> Column:
    return F.aggregate(
        F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v
    )


def dist(a, b) -> Column:
    return F.sqrt(sq_dist(a, b))


def norm_sq(a) -> Column:
    return F.aggregate(_c(a), F.lit(0.0), lambda acc, v: acc + v * v)


def _num(v: float) -> str:
    return f"CAST('{float(v)!r}' AS DOUBLE)" if v != v or v in (float("inf"), float("-inf")) else f"{float(v)!r}D"


def lit_vector(values: Sequence[float]) -> Column:
    """A model-sized vector as an ``array<double>`` literal (constant-folded once)."""
    return F.expr("array(" + ",".join(_num(v) for v in values) + ")") if len(values) else F.array().cast("array<double>")


def lit_matrix(rows: Sequence[Sequence[float]]) -> Column:
    """A small, model-sized matrix as an ``array<array<double>>`` literal.

    Ships centres / projection matrices / candidates to executors inside the
    plan; the size is bounded by the model, never by the data.
    """
    if not len(rows):
        return F.array().cast("array<array<double>>")
    return F.expr("array(" + ",".join("array(" + ",".join(_num(v) for v in r) + ")" for r in rows) + ")")


def matvec(mat_col: Column, vec) -> Column:
    """``mat`` (array of rows) times ``vec`` -> array of dot products."""
    v = _c(vec)
    return F.transform(mat_col, lambda row: dot(row, v))


def argmin_dist(mat_col: Column, vec, tie=None) -> Column:
    """Index of the nearest row of ``mat`` (squared Euclidean); ties by ``tie`` then index."""
    v = _c(vec)
    t = tie if tie is not None else F.lit(0)
    structs = F.transform(mat_col, lambda row, i: F.struct(sq_dist(row, v).alias("d"), t.alias("t"), i.alias("i")))
    return F.array_min(structs)["i"]
