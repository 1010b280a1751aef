"""Whitening of embeddings, with eigenvectors good to the last bit of a double.

Entries are put on a grid of integers, x = floor(64 c), so that sums and sums of products are exact and do not
depend on the order of rows, tasks or retries; adding 1000000 to every x changes no result. The fit list holds each distinct vector once (one aggregation over packed
vectors, combined before the shuffle). A first pass gives the count and the sums of each dimension; a second one subtracts
the rounded means before it multiplies, and adds products as whole numbers. Only sums of dimensions and pairs of dimensions
come to the driver: their size follows the width of the vectors, not their number.

The covariance is solved there: eigenvectors in float32, then the refinement of Ogita and Aishima by matrix products in
extended precision. Eigenvalues that lie too near to each other for a correction form a cluster, whose small matrix is
solved by itself, shifted by its mean; the next round then tells them apart.

Odd input: rows without a vector, or with a null or non-finite entry, are dropped, and so are empty vectors, which have no
component. Vectors of different widths are fitted apart, each width by itself. An empty table gives no rows. Repeated rows
count once in the fit and are all returned. A component without variance (fewer distinct vectors than dimensions, a single
vector) has null for ``whitened``. Vectors whose squared deviation does not fit a long end in an error, as do entries beyond
2^52 steps of the grid. Columns of the input are kept under their names; the new one takes the next free name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.llm.common import free_name, stage, table

SCALE = 64
COMPONENTS = 16
#: Rounds of refinement; from float32 three are usual, clusters need a few more.
ROUNDS = 20
#: Whole numbers below this are exact in a float64.
EXACT = 2**53
LOW = 32

PARTS = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()),
        T.StructField(
            "parts",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("component", T.IntegerType()),
                        T.StructField("whitened", T.DoubleType()),
                        T.StructField("explained", T.DoubleType()),
                    ]
                )
            ),
        ),
        T.StructField("identity_error", T.DoubleType()),
    ]
)


def grids(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, rows, matrix of floor(64 c)) of the sound vectors of a batch, a width at a time."""
    lists = column.cast(pa.large_list(pa.float64()))
    entries = lists.values.slice(lists.offsets[0].as_py(), lists.offsets[-1].as_py() - lists.offsets[0].as_py()) if len(lists) else lists.values
    offsets = lists.offsets.to_numpy() - (lists.offsets[0].as_py() if len(lists) else 0)
    values = entries.fill_null(np.nan).to_numpy(zero_copy_only=False)
    widths = np.diff(offsets)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    sound = (bad[offsets[1:]] == bad[offsets[:-1]]) & (widths > 0) & lists.is_valid().to_numpy(zero_copy_only=False)
    for width in np.unique(widths[sound]).tolist():
        rows = np.flatnonzero(sound & (widths == width))
        steps = np.floor(SCALE * values[offsets[rows][:, None] + np.arange(width)])
        if np.abs(steps).max() > 2**52:
            raise ValueError("an entry lies beyond 2^52 steps of the grid")
        yield width, rows, steps.astype(np.int64)


def pack(steps: np.ndarray) -> list[bytes]:
    """Bytes of each row, equal for equal rows: 32 bits an entry where all fit, else 64."""
    small = (np.abs(steps) < 2**31).all(axis=1)
    narrow = steps.astype("<i4")
    return [(narrow[i] if s else steps[i].astype("<i8")).tobytes() for i, s in enumerate(small)]


def unpack(width: int, bodies: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(b, "<i4" if len(b) == 4 * width else "<i8") for b in bodies]).astype(np.int64)


def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for width, _, steps in grids(batch.column(0)):
            yield pa.RecordBatch.from_arrays([pa.array([width] * len(steps), pa.int32()), pa.array(pack(steps), pa.binary())], ["width", "body"])


def by_width(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    for batch in batches:
        widths = batch.column(0).to_numpy()
        for width in np.unique(widths).tolist():
            yield width, unpack(width, batch.column(1).filter(pa.array(widths == width)).to_pylist())


def add_up(totals: dict, width: int, values: np.ndarray) -> None:
    """Add whole numbers to a pair of long sums, so that no total of a task overflows."""
    high, low = (values >> LOW).astype(np.int64), (values & (2**LOW - 1)).astype(np.int64)
    if width in totals:
        totals[width][0] += high
        totals[width][1] += low
    else:
        totals[width] = [high, low]


def batch_of(width: int, i: np.ndarray, j: np.ndarray, n: int, high: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
    size = len(i)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(size, width, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
            pa.array(np.full(size, n, np.int64)), pa.array(high), pa.array(low),
        ],
        ["width", "i", "j", "n", "high", "low"],
    )


SUMS = "width int, i int, j int, n long, high long, low long"


def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: count and sums of each dimension."""
    totals, counts = {}, {}
    for width, steps in by_width(batches):
        counts[width] = counts.get(width, 0) + len(steps)
        # halves, so that sums of a batch stay within a long
        add_up(totals, width, np.array([(int(h) << 26) + int(l) for h, l in zip((steps >> 26).sum(axis=0), (steps & (2**26 - 1)).sum(axis=0))], dtype=object))
    for width, (high, low) in totals.items():
        yield batch_of(width, np.arange(width), np.full(width, -1), counts[width], high, low)


def products(y: np.ndarray) -> Iterator[np.ndarray]:
    """Exact y' y, in parts whose entries stay whole in a float64."""
    most = int(np.abs(y).max(initial=0))
    if most * most >= EXACT:
        exact = y.astype(object)
        yield exact.T @ exact
        return
    step = max(1, (EXACT - 1) // max(1, most * most))
    for at in range(0, len(y), step):
        part = y[at : at + step].astype(np.float64)
        yield (part.T @ part).astype(np.int64)


def centred(width: int, steps: np.ndarray, centres: dict) -> np.ndarray:
    y = steps - centres[width]
    if len(y) and np.abs(y).max() >= 2**31:
        raise OverflowError("the squared deviation of a vector does not fit a long")
    return y


def gram(centres: dict):
    """Per task: sums of products of centred dimensions, upper triangle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {}
        for width, steps in by_width(batches):
            for part in products(centred(width, steps, centres)):
                add_up(totals, width, part)
        for width, (high, low) in totals.items():
            i, j = np.triu_indices(width)
            yield batch_of(width, i, j, 0, high[i, j].astype(np.int64), low[i, j].astype(np.int64))

    return run


def totals(df: DataFrame, task) -> dict[int, tuple[int, list]]:
    """{width: (n, [(i, j, exact sum)])}: as many rows as dimensions or pairs of them reach the driver."""
    out: dict[int, tuple[int, list]] = {}
    added = df.mapInArrow(task, SUMS).groupBy("width", "i", "j").agg(*(F.sum(c).alias(c) for c in ("n", "high", "low")))
    for r in added.toLocalIterator():
        out.setdefault(r["width"], (r["n"], []))[1].append((r["i"], r["j"], (r["high"] << LOW) + r["low"]))
    return out


def wide(value: int) -> np.longdouble:
    high = float(value)
    return np.longdouble(high) + np.longdouble(float(value - int(high)))


def covariance(n: int, offsets: list[int], pairs: list) -> np.ndarray:
    """V in extended precision: (n * sum of products - product of sums) / n^2, subtracted as whole numbers."""
    width = len(offsets)
    out = np.zeros((width, width), np.longdouble)
    for i, j, value in pairs:
        out[i, j] = out[j, i] = wide(n * value - offsets[i] * offsets[j])
    return out / np.longdouble(n) / np.longdouble(n)


def clusters(values: np.ndarray, width: np.longdouble) -> list[np.ndarray]:
    """Groups of two and more indices whose sorted values follow each other within ``width``."""
    order = np.argsort(values)
    groups = np.split(order, np.flatnonzero(np.diff(values[order]) > width) + 1)
    return [g for g in groups if len(g) > 1]


def orthonormal(x: np.ndarray) -> np.ndarray:
    """Nearly orthonormal columns, made so to the last bits."""
    for _ in range(2):
        x = x + x @ (np.eye(x.shape[1], dtype=x.dtype) - x.T @ x) / 2
    return x


def refined(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of symmetric ``a`` from rough vectors ``x``.

    Off-diagonal entries of x' a x over the gap of two eigenvalues turn their vectors; the symmetric half of the correction only
    restores orthogonality. Vectors of a cluster are not turned by gaps but by the eigenvectors of their own small matrix.
    """
    eps, one = np.finfo(np.longdouble).eps, np.eye(len(a), dtype=np.longdouble)
    norm = np.sqrt((a * a).sum())
    for _ in range(ROUNDS):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        limit = 2 * (np.sqrt((off * off).sum()) + norm * np.sqrt((r * r).sum()))
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= limit
        turn = np.where(near, 0, (s + values[None, :] * r) / np.where(near, 1, gap))
        e = r / 2 + (turn - turn.T) / 2
        x = x + x @ e
        solved = True
        for group in clusters(values, limit):
            basis = x[:, group]
            small = basis.T @ (a @ basis)
            small = (small + small.T) / 2
            small = small - np.diag(small).mean() * np.eye(len(group), dtype=np.longdouble)
            if np.abs(small - np.diag(np.diag(small))).max() > 64 * eps * norm:
                solved = False
                own = np.linalg.eigh((small / np.abs(small).max()).astype(np.float64))[1]
                x[:, group] = basis @ orthonormal(own.astype(np.longdouble))
        if solved and np.abs(e).max() < 1e-16:
            break
    x = orthonormal(x)
    return (x * (a @ x)).sum(axis=0), x


def components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``v``, falling, and their unit eigenvectors as columns; the largest entry of a vector is positive."""
    trace = np.trace(v)
    if not trace > 0:
        return np.zeros(len(v), np.longdouble), np.eye(len(v), dtype=np.longdouble)
    a = v / trace
    rough = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    values, x = refined(a, rough)
    order = np.argsort(-values, kind="stable")
    values, x = values[order], x[:, order]
    signs = np.sign(x[np.abs(x).argmax(axis=0), np.arange(len(v))])
    return values * trace, x * signs


def fit(df: DataFrame, column: str, count: int = COMPONENTS) -> dict[int, dict]:
    """Per width of vectors: n, sums, centre, components with variance and their scale, and the error of the identity."""
    distinct = stage(df.select(column).mapInArrow(keyed, "width int, body binary").distinct())
    models = {}
    for width, (n, rows) in totals(distinct, sums).items():
        total = [0] * width
        for i, _, value in rows:
            total[i] = value
        centre = [(2 * t + n) // (2 * n) for t in total]
        models[width] = {"n": n, "centre": np.array(centre, np.int64), "rest": [t - n * c for t, c in zip(total, centre)]}
    centres = {width: m["centre"] for width, m in models.items()}
    for width, (_, pairs) in totals(distinct, gram(centres)).items():
        m = models[width]
        v = covariance(m["n"], m["rest"], pairs)
        values, vectors = components(v)
        trace = np.trace(v)
        values = np.where(values > width * np.finfo(np.float64).eps * trace, values, 0)[:count]
        m["explained"] = (values / trace).astype(np.float64) if trace > 0 else np.zeros(len(values))
        m["vectors"] = vectors[:, :count].astype(np.float64)
        m["scale"] = np.sqrt(values).astype(np.float64)
        m["error"] = None
    errors(distinct, models)
    return models


def project(m: dict, y: np.ndarray) -> np.ndarray:
    """Whitened coordinates of centred rows; NaN for components without variance."""
    shift = np.array([float(r) for r in m["rest"]]) / m["n"]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(m["scale"] > 0, (y - shift) @ m["vectors"] / m["scale"], np.nan)


def errors(distinct: DataFrame, models: dict) -> None:
    """Set ``error`` of each model: largest entry of the covariance of whitened vectors minus the identity, over the fit list."""
    centres = {width: m["centre"] for width, m in models.items()}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for width, steps in by_width(batches):
            z = project(models[width], centred(width, steps, centres))[:, models[width]["scale"] > 0]
            z = np.concatenate([z, np.ones((len(z), 1))], axis=1)
            found[width] = found.get(width, 0) + z.T @ z
        for width, square in found.items():
            i, j = np.triu_indices(len(square))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), width, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(square[i, j])],
                ["width", "i", "j", "value"],
            )

    squares: dict[int, np.ndarray] = {}
    for r in distinct.mapInArrow(task, "width int, i int, j int, value double").groupBy("width", "i", "j").agg(F.sum("value").alias("value")).toLocalIterator():
        m = models[r["width"]]
        size = int((m["scale"] > 0).sum()) + 1
        squares.setdefault(r["width"], np.zeros((size, size)))[r["i"], r["j"]] = r["value"]
    for width, square in squares.items():
        n, means = models[width]["n"], square[:-1, -1] / models[width]["n"]
        excess = np.triu(square[:-1, :-1] / n - np.outer(means, means) - np.eye(len(means)))
        models[width]["error"] = float(np.abs(excess).max()) if len(means) else None


def deviations(m: dict, y: np.ndarray) -> list[int]:
    """Sum over dimensions of (n x - S)^2, as whole numbers."""
    most = max(m["n"] * int(np.abs(y).max(initial=0)) + max(map(abs, m["rest"])), 1)
    if most * most * y.shape[1] < 2**63:
        d = m["n"] * y - np.array(m["rest"], np.int64)
        return (d * d).sum(axis=1).tolist()
    out = [(sum((m["n"] * int(v) - r) ** 2 for v, r in zip(row, m["rest"]))) for row in y]
    if max(out) >= 2**63:
        raise OverflowError("the squared deviation of a vector does not fit a long")
    return out


def whiten(df: DataFrame, column: str = "embedding", count: int = COMPONENTS, out: str = "whitening") -> DataFrame:
    """Rows with a sound vector and all their columns, with a struct ``out``: n, deviation, parts (component, whitened, explained) and identity_error."""
    models = fit(df, column, count)
    centres = {width: m["centre"] for width, m in models.items()}
    at, out = df.columns.index(column), free_name(df, out)
    schema = T.StructType([*df.schema.fields, T.StructField(out, PARTS)])
    kind = pa.struct(
        [
            ("n", pa.int64()), ("deviation", pa.int64()),
            ("parts", pa.list_(pa.struct([("component", pa.int32()), ("whitened", pa.float64()), ("explained", pa.float64())]))),
            ("identity_error", pa.float64()),
        ]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, rows, steps in grids(batch.column(at)):
                m = models[width]
                y = centred(width, steps, centres)
                z = project(m, y)
                size = z.shape[1]
                flat = pa.StructArray.from_arrays(
                    [
                        pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(z))),
                        pa.array(z.ravel(), mask=np.isnan(z.ravel())),
                        pa.array(np.tile(m["explained"], len(z))),
                    ],
                    fields=list(kind.field("parts").type.value_type),
                )
                parts = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1, dtype=np.int32) * size), flat)
                made = pa.StructArray.from_arrays(
                    [pa.array([m["n"]] * len(z), pa.int64()), pa.array(deviations(m, y), pa.int64()), parts, pa.array([m["error"]] * len(z), pa.float64())],
                    fields=list(kind),
                )
                kept = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*kept.columns, made], schema=pa.schema([*kept.schema, pa.field(out, kind)]))

    return df.mapInArrow(task, schema)


def op11(spark: SparkSession, sf: str) -> DataFrame:
    rows = whiten(table(spark, sf, "embeddings").select("vec_id", "embedding"))
    parts = rows.select("vec_id", "whitening.n", "whitening.deviation", "whitening.identity_error", F.explode("whitening.parts").alias("p"))
    return parts.select("vec_id", "p.component", "n", "deviation", "p.whitened", "p.explained", "identity_error")
