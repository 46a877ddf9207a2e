"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Rows of whole numbers stand for the vectors; the fit list has each distinct one once. With X the centred fit
list, the method builds orthonormal right vectors v and left vectors u with X V = U B and Xᵀ U = V Bᵀ, where B is
upper bidiagonal. Each step is two distributed products: Xv, whose parts along the earlier u are taken off, and
Xᵀu, whose parts along the earlier v are. Both sides are orthogonalised anew against all earlier vectors, twice.
The singular values of the small B over the square root of the number of rows are the standard deviations, and its
right singular vectors turn V into the components.

A left vector has as many entries as the fit list has rows, so it is never stored: u = X w for a w with as many
entries as a row, and every task computes its entries from its own rows. The driver holds V, W and B only. Where
a direction is used up, or the rows have none left, the step's coefficient is 0 and the next right vector is a
fresh one, orthogonal to those before, so the basis is complete after as many steps as a row has entries and equal
or vanishing deviations are found whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.runtime import column, discard, ensure, stored

COMPONENTS = 16
#: Rows multiplied at once.
BLOCK_ROWS = 4096
#: Vectors longer than this would make the basis, which the driver holds and every task gets, larger than 32 MB.
MOST_ENTRIES = 2048


def _rows(batch: pa.RecordBatch, name: str, d: int) -> Iterator[np.ndarray]:
    """Blocks of the rows of a list column as a matrix of whole numbers."""
    for at in range(0, batch.num_rows, BLOCK_ROWS):
        part = column(batch, name).slice(at, BLOCK_ROWS)
        yield part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), d)


class _Fit:
    """The stored fit list; sums over its rows in a distributed pass.

    Differences from one of its rows stand for the rows, so constant entries of any size do no harm.
    """

    def __init__(self, rows: DataFrame, d: int):
        self.rows, self.d, self.n = rows, d, rows.count()
        first = rows.first()["x"]
        self.origin, self.sums = np.array(first, np.int64), np.zeros(d, np.int64)
        apart = F.array_max(F.transform(F.zip_with("x", F.array(*map(F.lit, first)), lambda a, b: a - b), F.abs))
        if rows.agg(F.max(apart)).first()[0] * self.n >= 2 ** 62:
            raise OverflowError("a deviation is beyond 64 bits")
        self.sums = self.total(lambda x: x.sum(axis=0), whole=True)

    def total(self, part: Callable[[np.ndarray], np.ndarray], whole: bool = False) -> np.ndarray:
        """The sum of ``part`` of every block of rows: centred ones, or the whole numbers themselves."""
        d, n, sums, origin, kind = self.d, self.n, self.sums, self.origin, "long" if whole else "double"

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = None
            for batch in batches:
                for x in _rows(batch, "x", d):
                    one = part(x - origin if whole else centred(x - origin, n, sums))
                    found = one if found is None else found + one
            if found is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(found))), pa.array(found)], ["at", "value"])

        got = self.rows.mapInArrow(work, f"at long, value {kind}").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
        out = np.zeros(got.num_rows, np.int64 if whole else np.float64)
        out[got["at"].to_numpy()] = got["value"].to_numpy()
        return out


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Rows less the mean, rounded once: the differences are taken on whole numbers."""
    return (n * x - sums) / n


def _against(basis: list[np.ndarray], v: np.ndarray) -> np.ndarray:
    for _ in range(2):
        for b in basis:
            v = v - (b @ v) * b
    return v


def bidiagonalise(fit: _Fit, steps: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(right vectors as columns, B) after the given number of steps."""
    d, draw = fit.d, np.random.default_rng(seed)
    right, weights, images = [], [], []  # v, the w of each u, and Xᵀu
    b = np.zeros((steps, steps))
    scale = float(np.sqrt(fit.total(lambda x: np.array([np.einsum("ij,ij->", x, x)]))[0])) or 1.0
    tiny = np.finfo(float).eps * scale * np.sqrt(d)
    v = None
    for k in range(steps):
        while v is None:
            v = _against(right, draw.standard_normal(d))
            v = v / norm if (norm := np.linalg.norm(v)) > 1e-8 else None
        right.append(v)
        left = np.array(weights).reshape(-1, d).T  # U = X left
        # Xv along the earlier u, and what is left of it.
        along = fit.total(lambda x: (x @ left).T @ (x @ v)) if k else np.zeros(0)

        def rest(x: np.ndarray) -> np.ndarray:
            u = x @ left
            q = x @ v - u @ along
            return np.concatenate([[q @ q], x.T @ q, u.T @ q])

        got = fit.total(rest)
        image, again = got[1:d + 1], got[d + 1:]
        # The second pass over what is left: its parts along the earlier u are known by now.
        size = np.sqrt(max(0.0, got[0] - again @ again))
        if k:
            image = image - np.array(images).T @ again
            along = along + again
            b[k - 1, k] = along[-1]  # those before are nothing but rounding
        if size <= tiny:  # the rows have nothing along v that the earlier u do not have
            weights.append(np.zeros(d))
            images.append(np.zeros(d))
            v = None
            continue
        b[k, k] = size
        weights.append((v - left @ along) / size)
        images.append(image / size)
        v = _against(right, images[-1])
        v = v / norm if (norm := np.linalg.norm(v)) > tiny else None
    return np.array(right).T, b


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = 64, shift: int = 1_000_000, vec_id: str = "vec_id",
           embedding: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each row and component.

    An entry c, as double, becomes the whole number floor(scale * c) + shift. Rows whose vector is null or empty or
    holds null or non-finite entries are left out, as are those of another length than most (of the longer one in a tie). ``n`` counts the
    distinct vectors, ``deviation`` is the exact sum of squares of n * x - S, ``whitened`` the centred row along the
    component over its standard deviation, ``explained`` the share of the component in all variance, and
    ``identity_error`` the largest entry by which the covariance of ``whitened`` over the fit list misses the
    identity. Components without variance have no whitened value and are left out, so a single distinct vector, like
    an empty table, gives no rows. Equal variances: any orthonormal basis of theirs may come. Rows that repeat, or
    share an id or have none, come out each. Columns of other names are not read. Entries beyond 2 ** 61 as whole numbers, a
    deviation beyond 64 bits and vectors of more than 2,048 entries raise an error.
    """
    ensure(vectors.sparkSession)
    entry = f"`{embedding}`"
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.expr(f"transform({entry}, e -> cast(e as double))").alias("x"))
    rows = rows.where("x is not null and size(x) > 0 and not exists(x, e -> e is null or isnan(e) or abs(e) = double('Infinity'))")
    too_large = F.expr(f"exists(x, e -> abs({scale} * e) > 2305843009213693952D)")
    whole = F.expr(f"transform(x, e -> cast(floor({scale} * e) as bigint) + {shift})")
    rows = rows.select("vec_id", F.when(too_large, F.raise_error(F.lit("an entry is too large for exact sums")).cast("array<bigint>")).otherwise(whole).alias("x"))
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return vectors.sparkSession.createDataFrame([], schema)
    d = lengths["d"]
    if d > MOST_ENTRIES:
        raise ValueError(f"vectors of {d} entries; at most {MOST_ENTRIES}")
    rows = rows.where(F.size("x") == d)
    fit = _Fit(stored(rows.select("x").distinct(), "fit-list"), d)
    n, sums, origin = fit.n, fit.sums, fit.origin
    right, b = bidiagonalise(fit, d)
    _, sigma, turned = np.linalg.svd(b)
    variance = sigma ** 2 / n
    most = int((sigma > np.finfo(float).eps * d * max(sigma[0], 1e-300) * 16).sum()) if sigma[0] > 0 else 0
    most = min(components, most)
    axes = (right @ turned.T)[:, :most]
    project = axes / np.sqrt(variance[:most])
    explained = variance[:most] / variance.sum() if most else np.zeros(0)
    error = 0.0
    if most:
        second = fit.total(lambda x: np.concatenate([(y := x @ project).sum(axis=0), (y.T @ y).ravel()])) / n
        error = float(np.abs(second[most:].reshape(most, most) - np.outer(second[:most], second[:most]) - np.eye(most)).max())
    discard(fit.rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, at = column(batch, "vec_id").cast(pa.int64()), 0
            for x in _rows(batch, "x", d):
                apart = n * (x - origin) - sums
                if np.abs(apart).max(initial=0) < 2 ** 31 / np.sqrt(d):
                    deviation = np.einsum("ij,ij->i", apart, apart)
                else:
                    deviation = np.array([sum(int(e) * int(e) for e in r) for r in apart], object)
                    if (deviation >= 2 ** 63).any():
                        raise OverflowError("a deviation is beyond 64 bits")
                values = (apart / n) @ project
                out = {"vec_id": ids.slice(at, len(x)).take(pa.array(np.repeat(np.arange(len(x)), most))),
                       "component": np.tile(np.arange(1, most + 1, dtype=np.int32), len(x)), "n": np.full(len(x) * most, n),
                       "deviation": np.repeat(deviation.astype(np.int64), most), "whitened": values.ravel(),
                       "explained": np.tile(explained, len(x)), "identity_error": np.full(len(x) * most, error)}
                at += len(x)
                yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in out.values()], list(out))

    return rows.mapInArrow(work, schema)
