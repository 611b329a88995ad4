"""Vector columns, ``array<float>`` or ``array<double>``, in expressions and in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def as_doubles(vec: str | Column) -> Column:
    vec = F.col(vec) if isinstance(vec, str) else vec
    return vec.cast("array<double>")


def norm(vec: str | Column) -> Column:
    return F.sqrt(F.aggregate(as_doubles(vec), F.lit(0.0), lambda total, x: total + x * x))


def dimension(df: DataFrame, vec: str = "vec") -> int:
    """Length of the vectors of a checked table, read off the first row; 1 where there is none."""
    row = df.select(F.size(vec).alias("dim")).limit(1).first()
    return row["dim"] if row else 1


def usable(vec: str | Column, dim: int) -> Column:
    """Whether a vector has ``dim`` entries, all of them finite numbers."""
    vec = F.col(vec) if isinstance(vec, str) else vec
    odd = F.exists(as_doubles(vec), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vec) == dim) & ~odd, F.lit(False))


def _look(df: DataFrame, vec: str, id_: str) -> DataFrame:
    """One row: how many rows and whole vectors (all entries finite) there are, their lengths, the least id of the rest, and
    the largest norm."""
    odd = F.exists(as_doubles(vec), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.coalesce(F.col(vec).isNotNull() & ~odd, F.lit(False))
    size = F.when(F.col(vec).isNotNull(), F.size(vec))
    return df.agg(
        F.count(F.lit(1)).alias("all"), F.count_if(whole).alias("whole"), F.min(size).alias("least"), F.max(size).alias("most"),
        F.mode(size).alias("common"), F.min(F.when(~whole, F.col(id_).cast("string"))).alias("odd"), F.max(F.when(whole, norm(vec))).alias("longest"),
    )


def _kept(df: DataFrame, look: Row, dim: int | None, invalid: str, vec: str, id_: str) -> tuple[DataFrame, int, int | None]:
    dim = look["common"] if dim is None else dim
    if look["whole"] == look["all"] and look["least"] == look["most"] and look["least"] in (dim, None):
        return df, look["all"], dim or None
    good = usable(vec, dim or 0)
    row = df.agg(F.count_if(good).alias("good"), F.min(F.when(~good, F.col(id_).cast("string"))).alias("odd")).first()
    if row["good"] < look["all"]:
        if invalid == "raise":
            raise ValueError(
                f"{look['all'] - row['good']} of {look['all']} vectors are not {dim} finite numbers, the one of id {row['odd']} among them"
            )
        df = df.filter(good)
    return df, row["good"], dim or None


def _known(invalid: str) -> None:
    if invalid not in ("raise", "skip"):
        raise ValueError(f"invalid is 'raise' or 'skip', not {invalid!r}")


def checked(df: DataFrame, dim: int | None = None, invalid: str = "raise", vec: str = "vec", id_: str = "id") -> tuple[DataFrame, int, int | None]:
    """(rows with usable vectors, their number, dimension) of a table (id, vec), in one pass, or two where some are not usable.

    The dimension is ``dim``, or else the commonest length; None without rows. Vectors that are null, of another
    length or not finite raise an error that names one of them, or with ``invalid="skip"`` are left out one by one.
    """
    _known(invalid)
    return _kept(df, _look(df, vec, id_).first(), dim, invalid, vec, id_)


def checked_pair(
    items: DataFrame, queries: DataFrame, invalid: str = "raise", vec: str = "vec", id_: str = "id"
) -> tuple[DataFrame, DataFrame, int, int, int | None, float]:
    """(items, queries, their numbers, dimension, largest norm of the items), as ``checked`` one after the other, from one job over both; the
    dimension is that of the items."""
    _known(invalid)
    looks = _look(items, vec, id_).withColumn("side", F.lit(0)).union(_look(queries, vec, id_).withColumn("side", F.lit(1)))
    first, second = sorted(looks.collect(), key=lambda row: row["side"])
    items, n_items, dim = _kept(items, first, None, invalid, vec, id_)
    queries, n_queries, _ = _kept(queries, second, dim, invalid, vec, id_)
    return items, queries, n_items, n_queries, dim, first["longest"] or 0.0


def matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of equal length as the rows of a matrix of doubles."""
    lengths = np.diff(np.asarray(vectors.offsets)) if len(vectors) else np.zeros(0)
    if vectors.null_count or vectors.flatten().null_count or (lengths != lengths[:1]).any():
        raise ValueError("vectors are null or differ in length")
    return np.asarray(vectors.flatten(), dtype=np.float64).reshape(len(vectors), -1)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows at length 1; a zero row stays zero and so scores 0 against everything."""
    size = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, size, out=np.zeros_like(rows), where=size > 0)


def band_of(rows: np.ndarray, longest: float, ratio: float, bands: int) -> np.ndarray:
    """Band of every row by its norm: band b ends at ``longest * ratio ** b``, the last one takes all shorter rows."""
    size = np.sqrt((rows * rows).sum(axis=1))
    if longest <= 0:
        return np.zeros(len(rows), np.int64)
    steps = np.floor(np.log(np.maximum(size, 1e-300) / longest) / np.log(ratio))
    return np.clip(steps, 0, bands - 1).astype(np.int64)


def pad_items(rows: np.ndarray, longest: float, band: float | None = None, bands: int = 1) -> np.ndarray:
    """Rows with ``sqrt(longest² - |row|²)`` appended: all get the norm ``longest``, and against
    queries padded with 0 the order by angle becomes the order by inner product.

    With ``band`` rows get the norm of their band's upper end instead, see ``band_of``: within a band the order by angle
    is that by inner product, and what is appended does not drown the shorter rows.
    """
    squares = (rows * rows).sum(axis=1, keepdims=True)
    ends = longest if band is None else longest * band ** band_of(rows, longest, band, bands)[:, None]
    return np.hstack([rows, np.sqrt(np.maximum(ends**2 - squares, 0.0))])


def pad_queries(rows: np.ndarray) -> np.ndarray:
    return np.hstack([rows, np.zeros((len(rows), 1))])
