"""Whitening of embeddings by the leading eigenvectors of their covariance.

The covariance is never formed. Jacobi-Davidson asks only for its products with
a few vectors at a time; each is one pass over the distinct vectors, centred in
the task before they are multiplied. Wanted pairs are corrected together, their
projected equations are solved by MINRES with one pass per step for all of them,
and a pair is locked when its residual, from a fresh product, has reached double
precision.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termspace.session import scratch_path, settle

# Entries become whole numbers of this fraction.
SCALE = 256.0
COMPONENTS = 4
# Bytes of the vectors that a task holds at once.
BLOCK_BYTES = 4 * 2**20
# A residual counts as zero below this many roundings of the largest eigenvalue, times the root of the dimensions.
ROUNDINGS = 4.0
# Partial sums that are added at once; more are first added in groups of so many.
FAN_IN = 256
# Steps of the inner solver, and basis vectors per wanted pair before a restart.
INNER_STEPS, BASIS = 12, 6
OUTER_STEPS = 200

Product = Callable[[np.ndarray], np.ndarray]


@dataclass
class Whitening:
    """n distinct vectors with sums S; components as rows, by falling eigenvalue."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float


def whole_vectors(rows: DataFrame, vector: str, name: str) -> DataFrame:
    """The rows whose vector has neither nulls nor entries that are not finite, with ``name``: its whole numbers.

    Vectors of another length than most are no vectors of this space and go too;
    of lengths that are equally frequent the longest counts. Empty ones go.
    """
    c = F.col(vector)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = rows.filter(c.isNotNull() & (F.size(c) > 0) & F.coalesce(finite, F.lit(False)))
    lengths = rows.groupBy(F.size(c).alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    rows = rows.filter(F.size(c) == (lengths["length"] if lengths else -1))
    return rows.withColumn(name, F.transform(c, lambda x: F.floor(x.cast("double") * SCALE)))


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS, block_bytes: int = BLOCK_BYTES, fan_in: int = FAN_IN) -> Whitening | None:
    """The whitening of the distinct vectors of a table (x array<long>), or None without any.

    Components without variance to double precision are left out: nothing scales
    them to one. What reaches the driver are sums of ``fan_in`` tasks at most, of
    a few vectors each.
    """
    spark = vectors.sparkSession
    work = scratch_path(spark, "whitening")
    distinct = vectors.select("x").distinct()
    blocks = settle(distinct.mapInArrow(_packed(block_bytes), "rows long, data binary"), "blocks", work)
    blocks = blocks.withColumn("part", F.spark_partition_id())
    first = blocks.first()
    if first is None:
        return None
    n = blocks.agg(F.sum("rows")).first()[0]
    d = len(first["data"]) // 8 // first["rows"]

    def total(local: Callable[[np.ndarray], np.ndarray], dtype=np.float64) -> np.ndarray:
        return _summed(blocks, local, d, dtype, fan_in)

    sums = total(lambda x: x.sum(axis=0), np.int64)
    mean = sums / n

    def product(vectors: np.ndarray) -> np.ndarray:
        def local(x: np.ndarray) -> np.ndarray:
            x = x - mean
            return (x.T @ (x @ vectors)).ravel()

        return total(local).reshape(vectors.shape) / n

    trace = float(total(lambda x: np.square(x - mean).sum(axis=0)).sum()) / n
    values, found = jacobi_davidson(product, d, min(components, d))
    kept = values > d * np.finfo(float).eps * trace
    values, found = values[kept], found[kept]
    k = len(values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ found.T / np.sqrt(values)
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    error = 0.0
    if k:
        sums_w = total(moments) / n
        covariance = sums_w[k:].reshape(k, k) - np.outer(sums_w[:k], sums_w[:k])
        error = float(np.abs(covariance - np.eye(k)).max())
    return Whitening(n, sums, values, found, trace, error)


def _packed(block_bytes: int):
    """Vectors of a task as blocks of 64-bit numbers, little-endian, of bounded size."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0)
            if not len(x):
                continue
            values = x.flatten().to_numpy().astype("<i8").reshape(len(x), -1)
            step = max(1, block_bytes // (8 * values.shape[1]))
            for start in range(0, len(values), step):
                part = values[start : start + step]
                yield pa.RecordBatch.from_pydict({"rows": [len(part)], "data": [part.tobytes()]})

    return pack


def _summed(blocks: DataFrame, local: Callable[[np.ndarray], np.ndarray], d: int, dtype, fan_in: int) -> np.ndarray:
    """The sum of ``local`` over all blocks, added in the same order each time."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, part = None, 0
        for batch in batches:
            for data, number in zip(batch["data"], batch["part"]):
                found = local(np.frombuffer(data.as_buffer(), "<i8").reshape(-1, d))
                mine, part = found if mine is None else mine + found, number.as_py()
        if mine is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "sums": [mine.astype(dtype).tobytes()]})

    def added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((p.as_py(), s.as_py()) for b in batches for p, s in zip(b["part"], b["sums"]))
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([key[0].as_py()], pa.int32()), "sums": [np.sum([np.frombuffer(s, dtype) for _, s in rows], axis=0).tobytes()]}
        )

    schema = "part int, sums binary"
    sums = blocks.mapInArrow(partial, schema)
    parts = blocks.rdd.getNumPartitions()
    while parts > fan_in:
        parts = -(-parts // fan_in)
        group = (F.col("part") / fan_in).cast("int").alias("group")
        sums = sums.groupBy(group).applyInArrow(added, schema)
    rows = sorted((r["part"], bytes(r["sums"])) for r in sums.collect())
    return np.sum([np.frombuffer(s, dtype) for _, s in rows], axis=0)


def jacobi_davidson(product: Product, d: int, wanted: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as rows) of the ``wanted`` largest eigenvalues of a symmetric operator, falling.

    ``product`` takes a matrix of columns. Equal eigenvalues are no trouble, as
    wanted pairs are corrected side by side.
    """
    locked, values = np.zeros((d, 0)), []
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((d, min(d, 2 * wanted))), locked)
    image = product(basis)
    for turn in range(OUTER_STEPS):
        # Rayleigh-Ritz in the basis, which is orthogonal to what is locked.
        projected = basis.T @ image
        theta, s = np.linalg.eigh((projected + projected.T) / 2)
        order = np.argsort(-theta)
        theta, s = theta[order], s[:, order]
        left = wanted - len(values)
        whole = basis.shape[1] + locked.shape[1] >= d
        u = basis @ s[:, :left]
        # Images turned and restarted many times have gathered roundings: residuals come from a fresh product.
        fresh = product(u)
        theta_u = np.einsum("ij,ij->j", u, fresh)
        residual = fresh - u * theta_u
        residual -= locked @ (locked.T @ residual)
        floor = ROUNDINGS * np.finfo(float).eps * np.sqrt(d) * max([*np.abs(values), *np.abs(theta_u)])
        done = np.linalg.norm(residual, axis=0) <= floor
        if whole and turn and not done.any():
            # Nothing is left to add; what remains is rounding.
            done[:] = True
        if done.any():
            locked = np.concatenate([locked, u[:, done]], axis=1)
            values += list(theta_u[done])
            keep = np.ones(len(theta), bool)
            keep[:left][done] = False
            basis, image, rest = basis @ s[:, keep], image @ s[:, keep], theta[keep]
            if len(values) == wanted:
                least = int(np.argmin(values))
                if not (len(rest) and rest[0] > values[least] + floor):
                    break
                # A larger one came into view after this one had been locked, which goes back.
                back = locked[:, [least]]
                locked, values = np.delete(locked, least, axis=1), values[:least] + values[least + 1 :]
                basis, image = np.concatenate([basis, back], axis=1), np.concatenate([image, product(back)], axis=1)
            elif not whole:
                basis, image = _grown(basis, image, residual[:, ~done], locked, product)
            continue
        if basis.shape[1] + left > BASIS * wanted:
            most = min(basis.shape[1], 3 * wanted)
            basis, image = basis @ s[:, :most], image @ s[:, :most]
        correction = _corrections(product, locked, u, theta_u, residual)
        basis, image = _grown(basis, image, correction, locked, product)
    else:
        raise ArithmeticError("eigenvectors did not reach double precision")
    values = np.array(values)
    order = np.argsort(-values, kind="stable")
    return values[order], locked.T[order]


def _grown(basis: np.ndarray, image: np.ndarray, more: np.ndarray, locked: np.ndarray, product: Product) -> tuple[np.ndarray, np.ndarray]:
    new = _orthonormal(more, np.concatenate([locked, basis], axis=1))
    if not new.shape[1]:
        return basis, image
    return np.concatenate([basis, new], axis=1), np.concatenate([image, product(new)], axis=1)


def _orthonormal(vectors: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal columns of ``vectors`` made orthogonal to ``against``; dependent ones are left out."""
    found: list[np.ndarray] = []
    for v in vectors.T:
        length = np.linalg.norm(v)
        if not length:
            continue
        v = v / length
        others = np.concatenate([against, *(f[:, None] for f in found)], axis=1) if found else against
        for _ in range(3):
            v = v - others @ (others.T @ v)
            length = np.linalg.norm(v)
            if length < 1e-12:
                break
            v = v / length
        else:
            found.append(v)
    return np.stack(found, axis=1) if found else np.zeros((len(vectors), 0))


def _corrections(product: Product, locked: np.ndarray, u: np.ndarray, theta: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """MINRES on (1 - QQ')(A - theta)(1 - QQ') t = -r for every pair at once; Q is what is locked or wanted.

    One product per step serves all pairs. A pair whose equation is solved well
    enough stands still while the others go on.
    """
    q = np.concatenate([locked, u], axis=1)
    project = lambda v: v - q @ (q.T @ v)
    b = project(-residual)
    beta = np.linalg.norm(b, axis=0)
    goal = 1e-3 * beta
    x, w, w_old = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    v, v_old = b / np.where(beta > 0, beta, 1), np.zeros_like(b)
    eta, gamma, gamma_old = beta.copy(), np.ones_like(beta), np.ones_like(beta)
    sigma, sigma_old, off = np.zeros_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    active = beta > 0
    for _ in range(INNER_STEPS):
        if not active.any():
            break
        z = np.zeros_like(b)
        mine = v[:, active]
        z[:, active] = project(product(mine) - mine * theta[active])
        alpha = np.einsum("ij,ij->j", v, z)
        z = z - v * alpha - v_old * off
        after = np.linalg.norm(z, axis=0)
        # The new column of the tridiagonal matrix, turned by the last two rotations and then by its own.
        one = gamma * alpha - gamma_old * sigma * off
        two = sigma * alpha + gamma_old * gamma * off
        three = sigma_old * off
        size = np.hypot(one, after)
        active &= size > 0
        safe = np.where(size > 0, size, 1)
        gamma_new, sigma_new = one / safe, after / safe
        w_new = (v - w_old * three - w * two) / safe
        x = np.where(active, x + w_new * (gamma_new * eta), x)
        eta = np.where(active, -sigma_new * eta, eta)
        w_old, w = w, w_new
        v_old, v = v, z / np.where(after > 0, after, 1)
        gamma_old, gamma, sigma_old, sigma, off = gamma, gamma_new, sigma, sigma_new, after
        active &= (np.abs(eta) > goal) & (after > 0)
    return project(x)


def whiten(
    rows: DataFrame,
    vector: str = "embedding",
    key: str = "vec_id",
    components: int = COMPONENTS,
    name: str = "component",
) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): one row per vector and component.

    Rows without a whole, finite vector of the table's dimension are left out
    (``whole_vectors``). The whitening is fitted on every different vector once,
    so repeated rows and ties of vectors do not weigh; each repeated row gets its
    own results, and a null key stays null. Components without variance are left
    out, so one vector, or none, gives no rows. ``deviation`` is null where it
    does not fit 64 bits. Other columns do not matter.
    """
    rows = rows.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    vectors = whole_vectors(rows, "vector", "x").select("key", "x")
    model = fit_whitening(vectors, components)
    schema = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return vectors.select(F.col("key").alias(key), *[F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in schema.split(", ")]).limit(0)
    k, sums, n = len(model.values), model.sums, model.n
    mean, scaled = sums / n, (model.components / np.sqrt(model.values)[:, None]).T
    explained = model.values / model.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch["x"].flatten().to_numpy().reshape(batch.num_rows, -1)
            # Whole numbers wrap round, so the sum is exact wherever it fits; whether it does shows in floats.
            with np.errstate(over="ignore"):
                far = n * x - sums
                deviation = (far * far).sum(axis=1)
            about = np.square(n * x.astype(float) - sums).sum(axis=1)
            whitened = (x - mean) @ scaled
            each = np.repeat(np.arange(batch.num_rows), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"].take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(len(each), n)),
                    pa.array(deviation[each], mask=(about >= 2.0**63)[each]),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(explained, batch.num_rows)),
                    pa.array(np.full(len(each), model.identity_error)),
                ],
                ["key", *[f.split()[0] for f in schema.split(", ")]],
            )

    kind = rows.schema["key"].dataType.simpleString()
    return vectors.mapInArrow(project, f"key {kind}, {schema}").withColumnRenamed("key", key)
