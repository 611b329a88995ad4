"""Whitening of vectors: exact covariance sums on Spark, its leading eigenpairs by spectrum slicing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.sources.store import materialize

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
RATIO = (1 + 17**0.5) / 8  # of Bunch and Parlett: below it a pair of rows is eliminated at once
EPS = np.finfo(np.float64).eps
_EXACT = 1 << 53


def inertia(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are above ``shift``: the positive pivots of the LDLᵀ of the shifted
    matrix (Sylvester). Rows are eliminated alone or in pairs, whichever keeps the rest small; a pair has one positive
    and one negative eigenvalue."""
    rest = matrix - shift * np.eye(len(matrix))
    above = 0
    while len(rest):
        diagonal = np.abs(np.diag(rest))
        at = int(diagonal.argmax())
        off = np.abs(rest)
        np.fill_diagonal(off, 0)
        i, j = np.unravel_index(int(off.argmax()), off.shape)
        if diagonal[at] == 0 and off[i, j] == 0:
            return above  # what is left is zero: eigenvalues at the shift
        chosen = [at] if len(rest) == 1 or diagonal[at] >= RATIO * off[i, j] else [i, j]
        others = np.setdiff1d(np.arange(len(rest)), chosen, assume_unique=True)
        pivot, side = rest[np.ix_(chosen, chosen)], rest[np.ix_(others, chosen)]
        above += 1 if len(chosen) == 2 else int(pivot[0, 0] > 0)
        rest = rest[np.ix_(others, others)]
        if len(others):
            rest = rest - side @ np.linalg.solve(pivot, side.T)
            rest = (rest + rest.T) / 2
    return above


def _solve(matrix: np.ndarray, shift: float, right: np.ndarray, size: float) -> np.ndarray:
    """Solution for the shifted matrix, which may be singular: then the shift moves by a rounding error."""
    eye = np.eye(len(matrix))
    for nudge in (0.0, EPS, 4 * EPS, 64 * EPS):
        try:
            found = np.linalg.solve(matrix - (shift + nudge * size) * eye, right)
        except np.linalg.LinAlgError:
            continue
        most = np.abs(found).max()
        if np.isfinite(most):
            return found / most
    raise ArithmeticError("the shifted matrix stays singular")


def _without(vector: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """The unit vector of what is orthogonal to ``found``; subtracted twice against rounding."""
    for _ in range(2):
        for other in found:
            vector = vector - other * (other @ vector)
    return vector / np.linalg.norm(vector)


def _rayleigh(matrix: np.ndarray, low: float, high: float, beside: list[np.ndarray], size: float, seed: int) -> tuple[float, np.ndarray] | None:
    """The eigenpair in (low, high), by inverse iteration from the middle and then Rayleigh quotients as shifts, which
    converge cubically; None if the quotients leave the interval. It is orthogonal to the vectors ``beside``."""
    shift = (low + high) / 2
    vector = _without(np.random.default_rng(seed).standard_normal(len(matrix)), beside)
    for _ in range(3):
        vector = _without(_solve(matrix, shift, vector, size), beside)
    value, best = float(vector @ matrix @ vector), np.inf
    for _ in range(30):
        error = float(np.linalg.norm(matrix @ vector - value * vector))
        if error >= best / 2 and best <= 1e3 * EPS * size:
            break
        best = min(best, error)
        vector = _without(_solve(matrix, value, vector, size), beside)
        value = float(vector @ matrix @ vector)
    return (value, vector) if low <= value <= high and best <= 1e4 * EPS * size else None


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns): the ``k`` largest of a symmetric matrix, or all if fewer, in falling order.

    Bisection with inertia counts narrows an interval around the i-th largest until no other eigenvalue lies in it; there
    the Rayleigh quotients start. At the end counts on both sides of each value certify its number, or an
    error is raised. Eigenvalues that lie within rounding of each other are one interval with as many vectors,
    orthogonal to each other.
    """
    n = len(matrix)
    k = min(k, n)
    matrix = (matrix + matrix.T) / 2
    size = float(np.abs(matrix).sum(axis=1).max()) if n else 0.0
    if size == 0:
        return np.zeros(k), np.eye(n)[:, :k]
    near = 8 * n * EPS * size
    counts = {-size - near: n, size + near: 0}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = inertia(matrix, shift)
        return counts[shift]

    values: list[float] = []
    vectors: list[np.ndarray] = []
    while len(values) < k:
        number = len(values) + 1
        low = max(s for s, c in counts.items() if c >= number)
        high = min(s for s, c in counts.items() if c < number and s > low)
        found = None
        while found is None:
            alone, narrow = above(low) - above(high) == 1, high - low <= 2 * near
            if narrow or alone:
                pairs: list[tuple[float, np.ndarray]] = []
                for turn in range(above(low) - above(high)):
                    # a neighbour just outside must not be taken for the one inside, until they cannot be told apart
                    slack = near if narrow else -near
                    beside = vectors + [v for _, v in pairs]
                    pair = _rayleigh(matrix, low - slack, high + slack, beside, size, 31 * number + turn)
                    if pair is None:
                        break
                    pairs.append(pair)
                else:
                    found = pairs
            if found is None:
                middle = (low + high) / 2
                if not low < middle < high or narrow:
                    raise ArithmeticError(f"eigenvalue {number} is not found between {low} and {high}")
                low, high = (middle, high) if above(middle) >= number else (low, middle)
        for value, vector in sorted(found, key=lambda pair: -pair[0]):
            values.append(value)
            vectors.append(vector)
    for number, value in enumerate(values, 1):
        if not (above(value - 4 * near) >= number and above(value + 4 * near) < number):
            raise ArithmeticError(f"eigenvalue {number} is misnumbered")
    return np.array(values[:k]), np.stack(vectors[:k], axis=1)


def scaled(rows: DataFrame, id_: str, vec: str, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(id, x): entries ``floor(scale * c) + offset`` of the vectors that take part: not null, all entries finite, and of
    the commonest length (the shorter, of two as common). Entries beyond the range of a long are an error."""
    odd = F.exists("_vec", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    own = rows.select(F.col(id_).alias("id"), F.col(vec).cast("array<double>").alias("_vec")).filter(F.col("_vec").isNotNull() & ~odd)
    whole = materialize(own.select("id", F.transform("_vec", lambda c: F.floor(c * scale) + offset).alias("x")), "whitening-vectors")
    size = whole.agg(F.mode(F.size("x"), True).alias("dim")).first()["dim"]
    return whole.filter(F.size("x") == (size or 0))


def _matrix(x: pa.Array, n: int) -> np.ndarray:
    return np.asarray(x.flatten(), dtype=np.int64).reshape(n, -1)


def _moments(base: np.ndarray):
    """Per task the exact sums of products of ``x - base``, as (i, j, total) with i not above j."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim = len(base)
        total = np.zeros((dim, dim), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            gaps = _matrix(batch["x"], batch.num_rows) - base
            largest = int(np.abs(gaps).max()) if gaps.size else 0
            if largest * largest >= _EXACT:
                wide = gaps.astype(object)
                total = total + wide.T @ wide
                continue
            # so many rows that the sums of their products are whole numbers that doubles hold
            step = max(1, min(len(gaps), (_EXACT - 1) // max(1, largest * largest)))
            for at in range(0, len(gaps), step):
                part = gaps[at : at + step].astype(np.float64)
                total = total + (part.T @ part).astype(np.int64)
        i, j = np.triu_indices(dim)
        sums = pa.array([Decimal(int(s)) for s in total[i, j]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), sums], ["i", "j", "total"])

    return run


@dataclass
class Whitening:
    """Fitted to all vectors of a table: their number, sums, and leading components."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @classmethod
    def fit(cls, vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
        """From (id, x), see ``scaled``; None where there are no rows.

        Sums are exact whole numbers, so neither the order of tasks nor the size of ``n`` changes a bit of them. Products
        are taken of entries less their mean rounded to a whole number; the rest of the mean, below a half, is
        taken off exactly. What the driver gets has the size of the covariance, ``dim * (dim + 1) / 2`` numbers.
        """
        entries = vectors.select(F.posexplode("x").alias("i", "c")).groupBy("i")
        first = entries.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("c").cast("decimal(20,0)")).alias("s")).orderBy("i").collect()
        if not first:
            return None
        n, sums = first[0]["n"], [int(row["s"]) for row in first]
        dim, base = len(sums), np.array([round(Fraction(s, n)) for s in sums], dtype=np.int64)
        products = vectors.select("x").mapInArrow(_moments(base), "i int, j int, total decimal(38,0)")
        rest = [s - n * int(b) for s, b in zip(sums, base)]
        covariance = np.zeros((dim, dim))
        for row in products.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
            i, j = row["i"], row["j"]
            covariance[i, j] = covariance[j, i] = float(Fraction(n * int(row["total"]) - rest[i] * rest[j], n * n))
        values, columns = leading(covariance, components)
        return cls(n, sums, values, columns, float(np.trace(covariance)))

    def transform(self, vectors: DataFrame) -> DataFrame:
        """(id, deviation, whitened array): see ``whiten``."""
        n, sums = self.n, np.array(self.sums, dtype=object)
        mean = np.array([float(Fraction(s, n)) for s in self.sums])
        with np.errstate(divide="ignore"):
            weights = np.where(self.usable, 1 / np.sqrt(np.maximum(self.values, 0)), np.nan)
        columns = self.vectors * weights
        small = max((abs(s) for s in self.sums), default=0) < 1 << 62
        whole = sums.astype(np.int64) if small else sums

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch["x"], batch.num_rows)
                largest = int(np.abs(x).max()) if x.size else 0
                if small and n * largest < 1 << 62:
                    gaps = n * x - whole
                    # the squares and their sum have to fit as well
                    if gaps.size and int(np.abs(gaps).max()) ** 2 * x.shape[1] >= 1 << 63:
                        gaps = gaps.astype(object)
                else:
                    gaps = n * x.astype(object) - sums
                squares = (gaps * gaps).sum(axis=1)
                made = (x - mean) @ columns
                deviation = pa.array([Decimal(int(s)) for s in squares], pa.decimal128(38, 0))
                at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * made.shape[1])
                values = pa.array(made.ravel(), mask=np.isnan(made.ravel()))
                yield pa.RecordBatch.from_arrays([batch["id"], deviation, pa.ListArray.from_arrays(at, values)], ["id", "deviation", "whitened"])

        kind = vectors.schema["id"].dataType.simpleString()
        return vectors.select("id", "x").mapInArrow(run, f"id {kind}, deviation decimal(38,0), whitened array<double>")

    @property
    def usable(self) -> np.ndarray:
        """Which components have a variance that is more than rounding."""
        return self.values > 8 * len(self.sums) * EPS * self.trace

    def identity_error(self, whitened: DataFrame) -> float:
        """The largest absolute entry of the covariance of the whitened rows, over the usable components, less the
        identity. Tasks add up products of values less the task's own mean, and means are made up for as the tasks meet."""
        wanted = np.flatnonzero(self.usable)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, mean, spread = 0, np.zeros(len(wanted)), np.zeros((len(wanted), len(wanted)))
            for batch in batches:
                if batch.num_rows:
                    rows = np.asarray(batch["whitened"].flatten()).reshape(batch.num_rows, -1)[:, wanted].astype(np.float64)
                    n, mean, spread = _joined((n, mean, spread), (len(rows), rows.mean(axis=0), np.cov(rows.T, bias=True).reshape(spread.shape) * len(rows)))
            columns = [pa.array([n]), pa.array([mean], pa.list_(pa.float64())), pa.array([spread.ravel()], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, ["n", "mean", "spread"])

        if not len(wanted):
            return 0.0
        parts = whitened.select("whitened").mapInArrow(run, "n bigint, mean array<double>, spread array<double>")
        # one row of some 70 numbers per task; sums of them meet on the executors
        merged = parts.filter("n > 0")
        total = merged.agg(F.sum("n").alias("n")).first()["n"]
        at = merged.select("n", F.posexplode("mean").alias("i", "m")).groupBy("i").agg((F.sum(F.col("n") * F.col("m")) / total).alias("m"))
        mean = np.array([row["m"] for row in at.orderBy("i").collect()])
        centred = F.transform("mean", lambda m, i: m - F.get(F.array(*[F.lit(float(m)) for m in mean]), i))
        entries = merged.withColumn("_gap", centred).select("n", "_gap", F.posexplode("spread").alias("at", "s"))
        i, j = F.floor(F.col("at") / len(wanted)).cast("int"), F.col("at") % len(wanted)
        sums = entries.groupBy("at").agg((F.sum(F.col("s") + F.col("n") * F.get("_gap", i) * F.get("_gap", j)) / total).alias("v"))
        found = np.zeros(len(wanted) ** 2)
        for row in sums.collect():
            found[row["at"]] = row["v"]
        return float(np.abs(found.reshape(len(wanted), -1) - np.eye(len(wanted))).max())


def _joined(a: tuple, b: tuple) -> tuple:
    """(rows, mean, sum of centred products) of two parts together."""
    n, gap = a[0] + b[0], b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


def whiten(
    rows: DataFrame, components: int = COMPONENTS, id_: str = "id", vec: str = "vec", scale: int = SCALE, offset: int = OFFSET
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): one row per vector and component.

    Vectors become whole numbers x, see ``scaled`` for those that take part, and the covariance V is over all ``n``
    of them. Components are V's unit eigenvectors, from 1 by falling eigenvalue, as many as ``components`` or the
    dimension. ``deviation`` is the sum over dimensions of ``(n * x - S) ** 2``, exact, as decimal(38,0); ``whitened`` is
    x less the mean, projected on the component, over the root of its eigenvalue; ``explained`` the eigenvalue's share
    of V's trace; ``identity_error`` the largest absolute entry of the whitened values' covariance less the identity.

    A component without variance (eigenvalue 0 within rounding, as when all rows are copies) has null ``whitened`` and
    takes no part in ``identity_error``; where nothing varies, ``explained`` is 0. Rows that share an id, copies and
    null ids are rows like others. Empty vectors and empty tables give no rows.
    """
    vectors = scaled(rows, id_, vec, scale, offset)
    model = Whitening.fit(vectors, components)
    kind = vectors.schema["id"].dataType.simpleString()
    if model is None:
        return rows.sparkSession.createDataFrame(
            [], f"id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
        )
    whitened = materialize(model.transform(vectors), "whitened")
    shares = [max(0.0, float(v)) / model.trace if model.trace > 0 else 0.0 for v in model.values]
    each = whitened.select("id", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return each.select(
        "id", (F.col("_at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(F.array(*[F.lit(s) for s in shares]), F.col("_at")).alias("explained"), F.lit(model.identity_error(whitened)).alias("identity_error"),
    )


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    """Every vector on the first eight components. A deviation that does not fit a long is an error."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    out = whiten(rows, id_="vec_id", vec="embedding")
    return out.withColumnRenamed("id", "vec_id").withColumn("deviation", F.col("deviation").cast("bigint"))
