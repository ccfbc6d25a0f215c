"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance of all vectors come from products of that
covariance with a narrow block of vectors: one distributed pass each, in which a task sums
C'(CQ) over its own centred rows C. The covariance itself is never formed. A filter round
runs the Chebyshev recurrence, whose polynomial stays below one on the unwanted part of the
spectrum and grows steeply above it; QR and Rayleigh-Ritz on the driver, on matrices of the
block's size, give the next eigenvalues and the next interval.

Two extra columns ride along with the passes at no further cost: a Lanczos vector that finds
the lower end of the spectrum, so that the interval is tight, and a random probe per round.
What is left of the probes outside the subspace tells whether an eigenvalue was missed: the
rounds end when residuals are at rounding level and the odds of a miss are below one in a
thousand million.

Entries become integers first, floor(64 c) + 1000000, so that counts, sums and deviations
are exact and means carry no rounding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txspark.llm.common import fresh, quoted, ship, stored

SCALE, SHIFT = 64, 1_000_000
LONG = 1 << 63


@dataclass(frozen=True)
class Settings:
    """components wanted; guard: further columns of the subspace; growth: the largest power of e
    by which one filter round may raise a component (double precision bears no more); residual:
    of an eigenvector, relative to the largest eigenvalue; settled: where it may stay if it no
    longer falls; missed: the odds at which no eigenvalue counts as missed."""

    components: int = 32
    guard: int = 16
    lanczos: int = 16
    growth: float = 30.0
    most_degree: int = 12
    residual: float = 2e-14
    settled: float = 1e-11
    missed: float = 1e-9
    most_passes: int = 600
    seed: int = 3


@dataclass
class Model:
    """n vectors with sums `total` of each dimension; eigenvectors in the columns of `vectors`."""

    n: int
    total: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    passes: int
    identity_error: float = 0.0

    @property
    def dimensions(self) -> int:
        return len(self.total)

    @property
    def scaled(self) -> np.ndarray:
        """Eigenvectors over the roots of their eigenvalues; a component without variance gives nan."""
        able = self.values > _nothing(self.values)
        return self.vectors / np.sqrt(np.where(able, self.values, np.nan))


def _nothing(values: np.ndarray) -> float:
    """What an eigenvalue must exceed to differ from rounding."""
    return 1e-12 * float(values.max(initial=0.0))


def usable(vector: Column) -> Column:
    """True for vectors that are not null and hold neither null nor non-finite entries."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def entries(vector: Column) -> Column:
    """The vector as integers; an entry that no long can hold is an error."""
    return F.transform(vector, lambda c: F.floor(SCALE * c.cast("double")).cast("long") + F.lit(SHIFT).cast("long"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _totals(rows: DataFrame, x: str) -> dict[int, tuple[int, list[int]]]:
    """For each vector length: the number of vectors and the exact sums of all dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            lengths = np.diff(column.offsets.to_numpy())
            for d in np.unique(lengths).tolist():
                own = _matrix(column.filter(pa.array(lengths == d)), d) if d else np.zeros((int((lengths == 0).sum()), 0), np.int64)
                # halves of 32 bits, whose sums over a batch cannot overflow
                high, low = (own >> 32).sum(axis=0), (own & 0xFFFFFFFF).sum(axis=0)
                yield pa.RecordBatch.from_pydict(
                    {
                        "d": pa.array([d] * (d + 1), pa.int32()),
                        "i": pa.array(range(-1, d), pa.int32()),
                        "high": pa.array([0, *high.tolist()], pa.int64()),
                        "low": pa.array([len(own), *low.tolist()], pa.int64()),
                    }
                )

    exact = "CAST(sum(CAST(high AS decimal(28, 0))) AS string)", "CAST(sum(CAST(low AS decimal(28, 0))) AS string)"
    found = (
        rows.select(*quoted([x]))
        .mapInArrow(run, "d int, i int, high long, low long")
        .groupBy("d", "i")
        .agg(F.expr(exact[0]).alias("high"), F.expr(exact[1]).alias("low"))
        .collect()
    )
    sums = {(r["d"], r["i"]): (int(r["high"]) << 32) + int(r["low"]) for r in found}
    return {d: (sums[d, -1], [sums[d, i] for i in range(d)]) for d in sorted({d for d, _ in sums})}


class _Centre:
    """Subtracts the mean: its whole part as integers, the rest, below one, as a double."""

    def __init__(self, n: int, total: list[int]) -> None:
        self.n = n
        whole = [s // n for s in total]
        self.whole = np.array(whole, np.int64)
        self.over = np.array([s - n * w for s, w in zip(total, whole, strict=True)], np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.over / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sums of (n x - S)^2; an error where a long cannot hold one."""
        near = x - self.whole
        reach = self.n * (int(np.abs(near).max(initial=0)) + 1)
        if reach * reach * max(x.shape[1], 1) < LONG:
            return ((near * self.n - self.over) ** 2).sum(axis=1).tolist()
        wide = [sum((self.n * int(v) - int(o)) ** 2 for v, o in zip(row, self.over, strict=True)) for row in near]
        if max(wide) >= LONG:
            raise OverflowError("A deviation is too large for a long")
        return wide


class _Passes:
    """Distributed products of the covariance with blocks of vectors."""

    def __init__(self, rows: DataFrame, x: str, centre: _Centre, d: int) -> None:
        self.rows = rows.where(F.size(*quoted([x])) == d).select(*quoted([x]))
        self.centre, self.d, self.done = centre, d, 0

    def _summed(self, made, kind: str = "i int, v array<double>") -> dict[int, np.ndarray]:
        """Sums of the arrays that tasks give for each i, added up by Spark."""
        cells = self.rows.mapInArrow(made, kind).select("i", F.posexplode("v").alias("j", "v"))
        found = cells.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
        self.done += 1
        out: dict[int, np.ndarray] = {}
        for i in {r["i"] for r in found}:
            out[i] = np.zeros(1 + max(r["j"] for r in found if r["i"] == i))
        for r in found:
            out[r["i"]][r["j"]] = r["v"]
        return out

    def times(self, block: np.ndarray) -> tuple[np.ndarray, float]:
        """Covariance times block, and the covariance's trace."""
        centre, d = self.centre, self.d

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, square, any_rows = np.zeros(block.shape), 0.0, False
            for batch in batches:
                c = centre(_matrix(batch.column(0), d))
                total += c.T @ (c @ block)
                square += float((c * c).sum())
                any_rows = True
            if any_rows:
                yield pa.RecordBatch.from_pydict(
                    {"i": pa.array(range(-1, d), pa.int32()), "v": pa.array([[square], *total.tolist()], pa.list_(pa.float64()))}
                )

        sums = self._summed(run)
        return np.stack([sums[i] for i in range(d)]) / centre.n, float(sums[-1][0]) / centre.n

    def whitened_covariance(self, scaled: np.ndarray) -> np.ndarray:
        """Covariance of the whitened vectors, centred on their own mean."""
        centre, d, k = self.centre, self.d, scaled.shape[1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, mean, any_rows = np.zeros((k, k)), np.zeros(k), False
            for batch in batches:
                w = centre(_matrix(batch.column(0), d)) @ scaled
                total += w.T @ w
                mean += w.sum(axis=0)
                any_rows = True
            if any_rows:
                yield pa.RecordBatch.from_pydict(
                    {"i": pa.array(range(-1, k), pa.int32()), "v": pa.array([mean.tolist(), *total.tolist()], pa.list_(pa.float64()))}
                )

        sums = self._summed(run)
        mean = sums[-1] / centre.n
        return np.stack([sums[i] for i in range(k)]) / centre.n - np.outer(mean, mean)


class _Lanczos:
    """The lower end of the spectrum, from one vector carried along in the passes."""

    def __init__(self, d: int, steps: int, rng: np.random.Generator) -> None:
        v = rng.normal(size=d)
        self.basis, self.steps = [v / np.linalg.norm(v)], min(steps, d)
        self.diagonal: list[float] = []
        self.beside: list[float] = []

    @property
    def vector(self) -> np.ndarray | None:
        return self.basis[-1] if len(self.diagonal) < self.steps else None

    def take(self, product: np.ndarray) -> None:
        self.diagonal.append(float(self.basis[-1] @ product))
        base = np.stack(self.basis, axis=1)
        rest = product
        for _ in range(2):
            rest = rest - base @ (base.T @ rest)
        size = float(np.linalg.norm(rest))
        if size <= 1e-13 * max(abs(x) for x in self.diagonal):
            self.steps = len(self.diagonal)  # an invariant subspace
            size = 0.0
        else:
            self.basis.append(rest / size)
        self.beside.append(size)

    def least(self) -> float:
        """Below the smallest eigenvalue but for bad luck with the start; 0 until known."""
        if self.vector is not None:
            return 0.0
        k = len(self.diagonal)
        t = np.diag(self.diagonal) + np.diag(self.beside[: k - 1], 1) + np.diag(self.beside[: k - 1], -1)
        values, vectors = np.linalg.eigh(t)
        return max(0.0, float(values[0] - abs(self.beside[k - 1] * vectors[-1, 0])))


def _log_chebyshev(x: float, degree: int) -> float:
    """Logarithm of the Chebyshev polynomial at x, 0 up to 1."""
    if x <= 1:
        return 0.0
    grown = degree * float(np.arccosh(x))
    return grown + float(np.log1p(np.exp(-2 * grown)) - np.log(2))


@dataclass
class _Probe:
    """A random vector after a filter round, and the round."""

    after: np.ndarray
    middle: float
    half: float
    first: float
    degree: int

    def log_odds(self, q: np.ndarray, level: float) -> float:
        """How likely a round shows no more than this outside q if an eigenvalue above `level`
        is missing there: its share of a random vector would have to be so small."""
        rest = self.after - q @ (q.T @ self.after)
        grown = _log_chebyshev((level - self.middle) / self.half, self.degree) - _log_chebyshev(self.first, self.degree)
        return min(0.0, float(np.log(max(np.linalg.norm(rest), 1e-300)) + np.log(len(rest)) / 2 - grown))


def _iterate(passes: _Passes, settings: Settings) -> tuple[float, np.ndarray, np.ndarray]:
    """(trace, eigenvalues, eigenvectors), largest first."""
    d, wanted = passes.d, min(settings.components, passes.d)
    width = min(d, wanted + settings.guard)
    rng = np.random.default_rng(settings.seed)
    if width == d:
        # the subspace is everything, and Rayleigh-Ritz on it exact after one pass
        whole, trace = passes.times(np.eye(d))
        values, vectors = np.linalg.eigh((whole + whole.T) / 2)
        return trace, values[::-1][:wanted].clip(0), vectors[:, ::-1][:, :wanted]
    lanczos = _Lanczos(d, settings.lanczos, rng)

    def times(block: np.ndarray) -> tuple[np.ndarray, float]:
        if lanczos.vector is None:
            return passes.times(block)
        product, trace = passes.times(np.column_stack([block, lanczos.vector]))
        lanczos.take(product[:, -1])
        return product[:, :-1], trace

    def with_probe(block: np.ndarray) -> np.ndarray:
        probe = rng.normal(size=d)
        return np.column_stack([block, probe / np.linalg.norm(probe)])

    # eigenvectors at rounding level are locked: all else stays orthogonal to them, so that they
    # no longer bound the growth that a round may have
    locked, fixed = np.zeros((d, 0)), np.zeros(0)

    def apart(block: np.ndarray) -> np.ndarray:
        return block - locked @ (locked.T @ block)

    q = with_probe(np.linalg.qr(rng.normal(size=(d, width)))[0])
    product, trace = times(q)
    probes: list[_Probe] = []
    seen: list[float] = []
    while True:
        # Rayleigh-Ritz; the last column is the next round's probe
        small = q[:, :-1].T @ product[:, :-1]
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q[:, :-1], product[:, :-1] = q[:, :-1] @ turn, product[:, :-1] @ turn
        found = np.concatenate([fixed, values])
        order = np.argsort(-found, kind="stable")[:wanted]
        top = float(found[order[0]])
        if top <= 0:
            return trace, np.zeros(wanted), q[:, :wanted]
        last = float(found[order][found[order] > _nothing(found)][-1])
        open_ = np.array([c for c in (order - len(fixed)).tolist() if c >= 0 and values[c] >= last], int)
        beside = np.linalg.norm(product[:, open_] - q[:, open_] * values[open_], axis=0) / top
        seen.append(float(beside.max(initial=0.0)))
        # rounding may keep residuals a little above the aim: then they no longer fall
        stuck = seen[-1] < settings.settled and seen[-1] > 0.3 * min([1.0, *seen[-4:-1]])
        done = open_[: int(np.argmax(np.append((beside > settings.residual) & (not stuck), True)))]
        low = min(lanczos.least(), float(values[-1]))
        odds = -np.inf if top - low <= 1e-9 * top else sum(p.log_odds(np.column_stack([locked, q[:, :-1]]), last + 1e-9 * top) for p in probes)
        goal = np.log(settings.missed)
        if len(done) == len(open_) and odds <= goal:
            vectors = np.column_stack([locked, q[:, :-1]])
            return trace, found[order].clip(0), vectors[:, order]
        if passes.done > settings.most_passes:
            raise RuntimeError(f"Components not certified in {passes.done} passes; the residual is {seen[-1]:.1e}")
        cut = max(min(float(values[-1]), low + 0.999 * (last - low)), low + 1e-9 * top)
        middle, half = (cut + low) / 2, (cut - low) / 2
        locked, fixed = np.column_stack([locked, q[:, done]]), np.concatenate([fixed, values[done]])
        kept = np.setdiff1d(np.arange(q.shape[1]), done)
        q, product = q[:, kept], apart(product[:, kept])
        q[:, -1] = apart(q[:, -1])
        values = np.delete(values, done)
        first = max((float(values.max(initial=cut)) - middle) / half, 1 + 1e-9)
        if len(done) == len(open_):
            # only the proof is left: as far as it takes
            degree = int((odds - goal + np.log(d) / 2 + 2) / np.arccosh((last + 1e-9 * top - middle) / half)) + 1
            degree = min(degree, max(settings.most_passes - passes.done, 2), int(600 / np.arccosh(max((top - middle) / half, 1.001))))
        else:
            degree = int(np.clip(settings.growth / np.arccosh(first), 2, settings.most_degree))
        # the recurrence, scaled so that the first component keeps its size
        shrink = 1 / first
        before, now = q, apart((product - middle * q) * (shrink / half))
        for _ in range(1, degree):
            step = 1 / (2 * first - shrink)
            product, _ = times(now)
            before, now = now, apart((2 * step / half) * (product - middle * now) - (shrink * step) * before)
            shrink = step
        probes.append(_Probe(now[:, -1].copy(), middle, half, first, degree))
        q = with_probe(np.linalg.qr(apart(np.linalg.qr(now[:, :-1])[0]))[0])
        product, _ = times(q)


def fit(rows: DataFrame, x: str, settings: Settings = Settings()) -> dict[int, Model]:
    """A model for each vector length among the integer vectors in column x.

    Reads the rows once for each pass, so they should be stored. To the driver come blocks of
    (dimensions) x (components + guard) numbers, never rows.
    """
    ship(rows.sparkSession)
    models = {}
    for d, (n, total) in _totals(rows, x).items():
        if not d:
            continue
        passes = _Passes(rows, x, _Centre(n, total), d)
        trace, values, vectors = _iterate(passes, settings)
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
        model = Model(n, total, trace, values, vectors, 0)
        able = values > _nothing(values)
        if able.any():
            spread = passes.whitened_covariance(model.scaled[:, able])
            model.identity_error = float(np.abs(spread - np.eye(len(spread))).max())
        model.passes = passes.done
        models[d] = model
    return models


KIND = "struct<deviation: long, whitened: array<double>>"


def project(x: Column, model: Model) -> Column:
    """deviation and whitened components of the integer vectors in a column."""
    centre, scaled = _Centre(model.n, model.total), model.scaled

    @F.pandas_udf(KIND)
    def run(column: pd.Series) -> pd.DataFrame:
        if not len(column):
            return pd.DataFrame({"deviation": pd.Series(dtype="int64"), "whitened": pd.Series(dtype=object)})
        own = np.stack(column.to_list())
        return pd.DataFrame({"deviation": centre.deviations(own), "whitened": list(centre(own) @ scaled)})

    return run(x)


def whitened(df: DataFrame, vector: str, settings: Settings = Settings(), out: str = "whitening") -> DataFrame:
    """The usable rows of df, all columns kept, with a struct column `out` of n, deviation,
    components (array of struct(component, whitened, explained)) and identity_error.

    Rows whose vector is null or holds null or non-finite entries go. Vectors of different
    lengths are spaces of their own: each has its own fit and n. Equal vectors get equal results,
    repeated rows stay and count. A component without variance (equal vectors, fewer vectors than
    components) has null for whitened and no part in identity_error. An empty table, or one
    without a usable vector, gives no rows; so do vectors of length 0. Where df already has
    a column `out`, underscores are put before the new one's name. Entries that are too large for
    a long, and deviations that are, raise an error.
    """
    x, out, p = fresh(df, "whitening_entries", out, "whitening_projected")
    (column,) = quoted([vector])
    rows = stored(df.where(usable(column)).withColumn(x, entries(column)), "whitening")
    parts = [_described(rows, x, out, p, d, model) for d, model in fit(rows, x, settings).items()]
    if parts:
        return reduce(DataFrame.union, parts)
    kind = (
        "struct<n: long, deviation: long, components: array<struct<component: int, whitened: double, explained: double>>, "
        "identity_error: double>"
    )
    return rows.where("false").withColumn(out, F.lit(None).cast(kind)).drop(x)


def _described(rows: DataFrame, x: str, out: str, p: str, d: int, model: Model) -> DataFrame:
    """The rows of one vector length with their results."""
    own = rows.where(F.size(F.col(x)) == d)
    shares = [float(v) / model.trace if model.trace > 0 else None for v in model.values]
    components = F.transform(
        F.arrays_zip(F.col(f"{p}.whitened").alias("w"), F.array(*[F.lit(s).cast("double") for s in shares]).alias("s")),
        lambda y, k: F.struct(
            (k + 1).cast("int").alias("component"),
            F.when(~F.isnan(y["w"]), y["w"]).alias("whitened"),
            y["s"].alias("explained"),
        ),
    )
    result = F.struct(
        F.lit(model.n).cast("long").alias("n"),
        F.col(f"{p}.deviation").alias("deviation"),
        components.alias("components"),
        F.lit(model.identity_error).alias("identity_error"),
    )
    return own.withColumn(p, project(F.col(x), model)).withColumn(out, result).drop(p, x)
