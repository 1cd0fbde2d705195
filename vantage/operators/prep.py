"""Table preparation: projections, casts, value maps, one-hot, scaling, formatting."""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def drop_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


def move_label_first(df: DataFrame, label: str) -> DataFrame:
    return df.select(label, *[c for c in df.columns if c != label])


def cast_category(df: DataFrame, cols: Sequence[str], to: str = "string") -> DataFrame:
    return df.select(*[F.col(c).cast(to).alias(c) if c in cols else F.col(c) for c in df.columns])


def replace_value(df: DataFrame, old, new, cols: Sequence[str] | None = None) -> DataFrame:
    """Frame-wide (or column-subset) value replacement, like ``replace(-1, 0)``."""
    cols = list(cols) if cols else None
    return df.replace(old, new, subset=cols)


def map_label(df: DataFrame, col: str, mapping: Mapping, out: str | None = None) -> DataFrame:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == F.lit(k), F.lit(v))) if expr is None else expr.when(F.col(col) == F.lit(k), F.lit(v))
    return df.withColumn(out or col, expr)


MAX_LEVELS = 10_000


def bounded(df: DataFrame, what: str, most: int = MAX_LEVELS) -> list:
    """Rows of a table that must be model-sized; more than ``most`` is an error, not a cut."""
    found = df.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{what} has more than {most} levels: not a categorical column")
    return found


def levels(df: DataFrame, col: str, max_levels: int = MAX_LEVELS) -> list:
    """Observed levels of a categorical column; more than ``max_levels`` is an error, not a cut."""
    return sorted(r[0] for r in bounded(df.select(col).distinct().where(F.col(col).isNotNull()), col, max_levels))


def one_hot(
    df: DataFrame, cols: Sequence[str], level_map: Mapping[str, Iterable] | None = None, drop: bool = True
) -> DataFrame:
    """0/1 column per observed level (no level dropped), named ``<col>_<level>``.

    Level discovery is one ``distinct`` per column; pass ``level_map`` to reuse a
    fitted encoding on new data (a row with an unseen level or a null gets all zeros).
    """
    out = df
    for c in cols:
        lv = list(level_map[c]) if level_map and c in level_map else levels(df, c)
        out = out.select(
            *out.columns,
            *[F.col(c).eqNullSafe(F.lit(v)).cast("int").alias(f"{c}_{v}") for v in lv],
        )
        if drop:
            out = out.drop(c)
    return out


def min_max_fit(df: DataFrame, cols: Sequence[str]) -> dict:
    """One aggregation pass; returns ``{col: (min, max)}`` (model-sized)."""
    row = df.agg(*[F.min(c).alias(f"mn_{i}") for i, c in enumerate(cols)],
                 *[F.max(c).alias(f"mx_{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"mn_{i}"], row[f"mx_{i}"]) for i, c in enumerate(cols)}


def min_max_scale(df: DataFrame, cols: Sequence[str], fitted: dict | None = None) -> DataFrame:
    """``(x-min)/(max-min)``; a constant column yields NULL (0/0 is undefined)."""
    fitted = fitted or min_max_fit(df, cols)
    exprs = {}
    for c in cols:
        mn, mx = fitted[c]
        exprs[c] = F.try_divide(F.col(c).cast("double") - F.lit(mn), F.lit(mx) - F.lit(mn)).alias(c) \
            if mn is not None else F.lit(None).cast("double").alias(c)
    return df.select(*[exprs.get(c, F.col(c)) for c in df.columns])


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features", legacy: bool = False) -> DataFrame:
    """Feature columns -> ``array<double>``.

    ``legacy=True`` reproduces the studied positional slice: the last feature
    is dropped and every value is truncated to a 64-bit integer.
    """
    use = list(cols)[:-1] if legacy else list(cols)
    elems = [F.col(c).cast("bigint").cast("double") if legacy else F.col(c).cast("double") for c in use]
    return df.withColumn(out, F.array(*elems))


def mask_filter(df: DataFrame, cond: Column) -> DataFrame:
    return df.where(cond)


def abs_threshold_correct(pred, actual, threshold: float = 0.5) -> Column:
    p = F.col(pred) if isinstance(pred, str) else pred
    a = F.col(actual) if isinstance(actual, str) else actual
    return (F.abs(p - a) < F.lit(threshold)).cast("int")


def linspace(start: float, stop: float, num: int, n_col: Column | None = None, mode: str = "floor") -> Column:
    """Array column of ``num`` evenly spaced values (``numpy.linspace``), optionally times ``n_col``.

    ``mode``: ``floor`` (int truncation), ``round`` (half-even like numpy), or ``none``.
    """
    step = (stop - start) / (num - 1) if num > 1 else 0.0
    scale = n_col if n_col is not None else F.lit(1.0)

    def f(i):
        v = (F.lit(float(start)) + i.cast("double") * F.lit(step)) * scale
        if mode == "floor":
            return F.floor(v).cast("bigint")
        if mode == "round":
            return F.bround(v, 0).cast("bigint")
        return v

    return F.transform(F.sequence(F.lit(0), F.lit(num - 1)), f)


def int_div(a, b) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    """Integer (truncating) division, as in Java ``int / int``."""
    return (a.cast("bigint") / b.cast("bigint")).cast("bigint")


def format_fixed(col, digits: int = 3) -> Column:
    """Java ``DecimalFormat("0.000")`` (half-even) rendering."""
    c = F.col(col) if isinstance(col, str) else col
    return F.format_string(f"%.{digits}f", F.bround(c.cast("double"), digits))


def format_date(col, fmt: str = "yyyy-MM-dd") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, fmt)


def csv_line(*cols) -> Column:
    return F.concat_ws(",", *[F.col(c) if isinstance(c, str) else c for c in cols])


def parse_fields(line, types: Sequence[str], names: Sequence[str], sep: str = ",") -> list[Column]:
    """Split a delimited line and cast each field (``try_cast``: bad fields become NULL)."""
    parts = F.split(F.col(line) if isinstance(line, str) else line, sep)
    return [F.try_element_at(parts, F.lit(i + 1)).try_cast(t).alias(n) for i, (t, n) in enumerate(zip(types, names))]


def lookup_default(key, mapping: Mapping, default) -> Column:
    """Map lookup with a default value (the map literal is model-sized)."""
    k = F.col(key) if isinstance(key, str) else key
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, k), F.lit(default))
