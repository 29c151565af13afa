"""Whitening of embeddings by shifted CholeskyQR.

The centred rows A are never held together. A pass sums their Gram matrix G = A'A over all tasks; the Cholesky
factor R of G, moved by a small shift so that it exists at any condition, makes A R^-1 nearly orthonormal, row by
row, through a triangular solve. Two or more further passes over A R^-1 repeat that, and the factors compose to
A = Q R. What the last pass measured of Q'Q enters the singular value decomposition of R, which gives the
components and their variances without ever squaring the condition of A.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playledger.llm.common import written

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
PASSES = 3
MOST_PASSES = 8
GROUPS = 64
"""Groups of tasks whose matrices are summed first; one matrix per group reaches the driver."""
HELD = 2.0**52
"""Components times SCALE are held between -HELD and HELD, where doubles are exact."""
NO_VARIANCE = 1e-13
"""Share of all variance up to which a component counts as having none."""
_WHITE = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Whitening:
    """n fitted vectors, their sums S (exact), components as columns, variances, and their sum."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def rank(self) -> int:
        return int((self.variances > NO_VARIANCE * self.trace).sum())

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: whole numbers first, so that nothing is lost to the size of x."""
        base = np.array([s // max(1, self.n) for s in self.sums], np.int64)
        rest = np.array([(s % max(1, self.n)) / max(1, self.n) for s in self.sums])
        return (x - base).astype(np.float64) - rest

    def whitened(self, x: np.ndarray, k: int) -> np.ndarray:
        """The first k components of each row, in units of their deviation; nan for those without variance."""
        k = min(k, len(self.sums))
        unit = np.full(k, np.nan)
        r = min(k, self.rank)
        unit[:r] = 1.0 / np.sqrt(self.variances[:r])
        return (self.centred(x) @ self.components[:, :k]) * unit

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n*x - S)**2 of each row, exact; null where it does not fit a long."""
        far = (self.n * self.centred(x)) ** 2
        exact: list[int | None] = []
        small = far.sum(1) < 2.0**62
        if small.any():
            sums = np.array([s if abs(s) < 2**62 else 0 for s in self.sums], np.int64)
            whole = self.n * x[small] - sums
            found = iter((whole * whole).sum(1).tolist())
        for i, fits in enumerate(small.tolist()):
            if fits and self._plain(x[i]):
                exact.append(next(found))
                continue
            if fits:
                next(found)
            value = sum((self.n * int(c) - s) ** 2 for c, s in zip(x[i], self.sums))
            exact.append(value if value < 2**63 else None)
        return exact

    def _plain(self, row: np.ndarray) -> bool:
        return self.n * max(1, int(np.abs(row).max(initial=0))) < 2**62 and all(abs(s) < 2**62 for s in self.sums)


def whole_vectors(embeddings: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id and x = floor(scale * c) + offset of each component c, of all rows whose vector is neither null nor
    holds null or non-finite entries. Of several lengths the commonest stays (the longest, if equally common)."""
    v = F.col("embedding")
    sound = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    held = F.lit(HELD)
    whole = F.transform(v, lambda c: F.floor(F.greatest(-held, F.least(held, c.cast("double") * F.lit(float(scale))))) + F.lit(offset))
    rows = embeddings.filter(v.isNotNull() & F.coalesce(sound, F.lit(False)))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.cast("array<bigint>").alias("x"))
    length = rows.groupBy(F.size("x").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    best = length.orderBy(F.col("n").desc(), F.col("length").desc()).limit(1).collect()
    return rows.filter(F.size("x") == (best[0].length if best else 0))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).astype(np.int64)


def summed(rows: DataFrame, width: int, size: int, terms) -> np.ndarray:
    """Sum over all rows of `terms(x)`, a vector of `size` doubles per block of rows; the same for the same tasks.

    A task adds its blocks and sends one vector, groups of tasks are added in Spark in a fixed order, and GROUPS vectors
    reach the driver at most.
    """

    def part(batches):
        total = np.zeros(size)
        for batch in batches:
            total = total + terms(_matrix(batch.column(0), width))
        yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "total"])

    def merged(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("part").to_numpy())
        parts = table.column("total").to_pylist()
        total = sum((np.frombuffer(parts[i]) for i in order), np.zeros(size))
        first = int(table.column("part").to_numpy().min())
        return pa.table({"part": pa.array([first], pa.int32()), "total": pa.array([total.tobytes()], pa.binary())})

    schema = "part int, total binary"
    parts = rows.select("x").mapInArrow(part, schema).withColumn("set", F.pmod("part", F.lit(GROUPS)))
    found = parts.groupBy("set").applyInArrow(merged, schema).collect()
    return sum((np.frombuffer(bytes(r.total)) for r in sorted(found, key=lambda r: r.part)), np.zeros(size))


def exact_sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows and the sum of each dimension, as whole numbers of any size."""

    def part(batches):
        n, low, high = 0, np.zeros(width, np.int64), np.zeros(width, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), width)
            n += len(x)
            low += (x & 0xFFFFFF).sum(0)
            high += (x >> 24).sum(0)
        rows = [(-1, n, 0), *((i, int(a), int(b)) for i, (a, b) in enumerate(zip(low, high)))]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows)], ["i", "low", "high"])

    sums = rows.select("x").mapInArrow(part, "i long, low long, high long")
    found = {r.i: r for r in sums.groupBy("i").agg(F.sum("low").alias("low"), F.sum("high").alias("high")).collect()}
    return (found[-1].low if found else 0), [(found[i].high << 24) + found[i].low if found else 0 for i in range(width)]


def fit(distinct: DataFrame) -> Whitening:
    """Fits a whitening to `distinct(x)`, each row a vector of whole numbers, all of one length.

    Passes over the rows: sums, then one Gram matrix per CholeskyQR pass. Three passes make Q orthonormal unless A
    lacks rank; then passes go on until Q'Q is one or zero in every direction. Only matrices of the vectors' length
    reach the driver.
    """
    head = distinct.limit(1).collect()
    width = len(head[0].x) if head else 0
    n, sums = exact_sums(distinct, width)
    if not n or not width:
        return Whitening(n, tuple(sums), np.zeros((width, width)), np.zeros(width), 0.0)
    start = Whitening(n, tuple(sums), np.eye(width), np.ones(width), float(width))
    r, gram = np.eye(width), _gram(distinct, start, np.eye(width))
    for turn in range(MOST_PASSES):
        values = np.linalg.eigvalsh(gram)
        near = 1e-10 if turn < PASSES else 1e-6
        if not values[-1] > 0 or turn and np.all((np.abs(values - 1) < near) | (values < near)):
            break
        # some eps of the norm per dimension bounds the error of the sums, so the factor exists
        singular = turn == 0 or values[0] < 1e-8
        shift = 11 * np.finfo(float).eps * width * (width + 1) * values[-1] if singular else 0.0
        r = np.linalg.cholesky(gram + shift * np.eye(width)).T @ r
        gram = _gram(distinct, start, r)
    # A = Q R with Q'Q = gram: the singular values of A are those of gram^(1/2) R
    values, turns = np.linalg.eigh(gram)
    root = (turns * np.sqrt(np.maximum(values, 0))) @ turns.T
    _, sigma, components = np.linalg.svd(root @ r)
    variances = sigma**2 / n
    return Whitening(n, tuple(sums), np.ascontiguousarray(components.T), variances, float(variances.sum()))


def _gram(distinct: DataFrame, start: Whitening, r: np.ndarray) -> np.ndarray:
    """Gram matrix of the centred rows times r^-1."""
    width = len(r)

    def terms(x):
        q = np.linalg.solve(r.T, start.centred(x).T)
        return (q @ q.T).ravel()

    gram = summed(distinct, width, width * width, terms).reshape(width, width)
    return (gram + gram.T) / 2


def identity_error(distinct: DataFrame, model: Whitening, k: int) -> float | None:
    """Largest absolute entry of the covariance of the whitened rows, less the identity; null without components."""
    width, r = len(model.sums), min(k, model.rank)
    if not r:
        return None

    def terms(x):
        white = model.whitened(x, r)
        return np.concatenate((white.sum(0), (white.T @ white).ravel()))

    total = summed(distinct, width, r + r * r, terms)
    mean = total[:r] / model.n
    covariance = total[r:].reshape(r, r) / model.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(r)).max())


def whiten(rows: DataFrame, model: Whitening, error: float | None, k: int = COMPONENTS) -> DataFrame:
    """A row per vector of `rows(vec_id, x)` and component up to k: vec_id, component, n, deviation, whitened, explained,
    identity_error. A component without variance explains 0 and has null for whitened."""
    width = len(model.sums)
    k = min(k, width)
    shares = [float(v / model.trace) if model.trace and i < model.rank else 0.0 for i, v in enumerate(model.variances[:k])]

    def project(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = _matrix(part.column(1), width)
                m = len(x)
                where = pa.array(np.repeat(np.arange(m), k))
                white = model.whitened(x, k).ravel()
                columns = [
                    part.column(0).take(where),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, np.int64)),
                    pa.array(model.deviations(x), pa.int64()).take(where),
                    pa.array(white, mask=np.isnan(white)),
                    pa.array(np.tile(np.array(shares), m), pa.float64()),
                    pa.array([error] * (m * k), pa.float64()),
                ]
                yield pa.record_batch(columns, [f.split()[0] for f in _WHITE.split(", ")])

    return rows.select("vec_id", "x").mapInArrow(project, _WHITE)


def whitened_components(embeddings: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """Whitens `embeddings(vec_id, embedding)`, fitted on each distinct vector of whole numbers once.

    Rows with a null vector or one that holds null or non-finite entries are left out, as are vectors of another length than
    the commonest; rows with a null or repeated vec_id stay, other columns are ignored. An empty table, or empty
    vectors, give no rows. Distinct vectors are found by folding in the map tasks, so a vector that holds a third
    of all rows costs one row per task.
    """
    rows = written(whole_vectors(embeddings))
    distinct = written(rows.select("x").distinct())
    model = fit(distinct)
    return whiten(rows, model, identity_error(distinct, model, k), k)
