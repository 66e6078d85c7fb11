"""Vector codes: product quantisation by k-means with adaptive distance bounds.

A vector of integers is cut into parts, and each part is coded by its nearest entry of the codebook
of its position. Between rounds every part keeps its entry with an upper bound of that distance, the
b next entries with ordered lower bounds, and one outer lower bound for all other entries. When
entries move, bounds move by as much. What the bounds settle is not computed again; of the rest, only
the entries below the upper bound are compared, by exact integers. b follows how deep the lists
were needed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import left_lookup
from ..session import fresh_path, stage
from ..sources.files import file_system
from . import common

_STATE = "x binary, entry binary, upper binary, near binary, low binary"


def _up(values: np.ndarray) -> np.ndarray:
    """Rounded to a 32-bit number that is greater."""
    return np.nextafter(values.astype(np.float32), np.float32(np.inf))


def _down(values: np.ndarray) -> np.ndarray:
    return np.nextafter(values.astype(np.float32), np.float32(-np.inf))


def _ordered(low: np.ndarray) -> np.ndarray:
    """Each bound lowered to the least of those after it, so that it holds for all of these, too."""
    return np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1]


@dataclass
class Bounds:
    """The state of one part position: entry, upper bound, b next entries, b + 1 lower bounds."""

    entry: np.ndarray
    upper: np.ndarray
    near: np.ndarray
    low: np.ndarray

    @classmethod
    def unknown(cls, n: int, b: int) -> Bounds:
        """Bounds that settle nothing."""
        return cls(
            np.zeros(n, np.uint8), np.full(n, np.inf, np.float32), np.zeros((n, b), np.uint8),
            np.zeros((n, b + 1), np.float32),
        )

    def shrunk(self, b: int) -> Bounds:
        """With the b nearest entries only; the outer bound then holds for the others as well."""
        return Bounds(self.entry, self.upper, self.near[:, :b], _ordered(self.low)[:, :b + 1])

    def moved(self, by: np.ndarray) -> Bounds:
        """Bounds after the entries moved by at most `by`."""
        low = self.low.astype(np.float64)
        low[:, :-1] -= by[self.near]
        low[:, -1] -= by.max()
        return Bounds(self.entry, _up(self.upper + by[self.entry]), self.near, _ordered(_down(low)))

    def assign(self, x: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Find the nearest entries, ties to the lower index; returns how deep each list was needed.

        Depth 0 needs no distance; depth z compares the entry and the z next ones; one more than
        there are bounds compares all.
        """
        b = self.near.shape[1]
        depth = (self.low <= self.upper[:, None]).sum(1)
        for z in range(1, b + 1):
            rows = np.flatnonzero(depth == z)
            if len(rows):
                some = np.sort(np.c_[self.entry[rows], self.near[rows, :z]], axis=1)
                square = ((x[rows, None] - entries[some]) ** 2).sum(2)
                order = np.argsort(square, axis=1, kind="stable")
                some, square = (np.take_along_axis(v, order, 1) for v in (some, square))
                self._put(rows, some, square, z)
        rows = np.flatnonzero(depth == b + 1)
        if len(rows):
            square = np.stack([((x[rows] - e) ** 2).sum(1) for e in entries], axis=1)
            order = np.argsort(square, axis=1, kind="stable")
            self._put(rows, order[:, :b + 1], np.take_along_axis(square, order[:, :b + 1], 1), b)
            if b + 1 < len(entries):
                outer = np.take_along_axis(square, order[:, b + 1:b + 2], 1)[:, 0]
                self.low[rows, b] = _down(np.sqrt(outer))
            else:
                self.low[rows, b] = np.inf
        return depth

    def _put(self, rows: np.ndarray, some: np.ndarray, square: np.ndarray, z: int) -> None:
        distance = np.sqrt(square)
        self.entry[rows] = some[:, 0]
        self.upper[rows] = _up(distance[:, 0])
        self.near[rows, :z] = some[:, 1:]
        self.low[rows, :z] = _down(distance[:, 1:])


@dataclass
class Codebooks:
    """The entries (part, entry, position) of a round, and how far each moved since the last."""

    entries: np.ndarray
    moves: np.ndarray

    @property
    def shape(self) -> tuple[int, int, int]:
        return self.entries.shape

    def next(self, sums: np.ndarray, counts: np.ndarray) -> Codebooks:
        """Entries replaced by the floored means of their parts; unused ones stay."""
        means = sums // np.maximum(counts, 1)[:, :, None]
        entries = np.where(counts[:, :, None] > 0, means, self.entries)
        moved = np.sqrt(((entries - self.entries) ** 2).sum(2)) * (1 + 1e-9)
        return Codebooks(entries, moved)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _integers(column: pa.Array, size: int, scale: int, parts: int) -> np.ndarray:
    """floor(scale * x) by vector, part and position."""
    x = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, size)
    whole = np.floor(x * scale)
    # Squared distances of a whole vector must fit 64 bits.
    if len(whole) and np.abs(whole).max() >= math.isqrt((1 << 61) // max(size, 1)):
        raise ValueError("a component is too large for exact 64-bit distances")
    return whole.astype(np.int32 if np.abs(whole).max(initial=0) < 1 << 31 else np.int64).reshape(
        len(x), parts, -1
    )


def _binary(values: np.ndarray) -> pa.Array:
    """One binary value a row."""
    values = np.ascontiguousarray(values)
    width = values.itemsize * math.prod(values.shape[1:])
    data = pa.py_buffer(values.tobytes())
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(width), len(values), [None, data]
    ).cast(pa.binary()) if width else pa.array([b""] * len(values), pa.binary())


def _values(column: pa.Array, kind, *shape: int) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).reshape(len(column), *shape).copy()


def _vectors(column: pa.Array, parts: int, width: int) -> np.ndarray:
    """The integers of a batch; a row of wide components makes its values 64 bits wide."""
    wide = 8 * parts * width
    rows = [np.frombuffer(v, np.int64 if len(v) == wide and width else np.int32) for v in column.to_pylist()]
    return np.array(rows, np.int64).reshape(len(rows), parts, width)


def _round(books: Codebooks, first: bool, had: int, b: int, fresh, last: bool):
    """One assignment of all parts, as a function over batches.

    `first` reads vectors and knows no bounds; otherwise the state has lists of `had` entries, of
    which b are kept. Each task ends with a row of its sums: what parts that changed their entry add
    to the entries' sums and counts, and how many parts needed each depth. The `last` round gives
    codes and errors.
    """
    parts, k, width = books.shape
    kind = np.dtype(np.int64)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, k, width), np.int64)
        counts = np.zeros((parts, k), np.int64)
        depths = np.zeros(b + 2, np.int64)
        schema = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if first:
                stored = fresh(batch.column("x"))
                x = stored.astype(kind)
                kept_x = _binary(stored)
                states = [Bounds.unknown(n, b) for _ in range(parts)]
            else:
                kept_x = batch.column("x")
                x = _vectors(kept_x, parts, width)
                entry = _values(batch.column("entry"), np.uint8, parts)
                upper = _values(batch.column("upper"), np.float32, parts)
                near = _values(batch.column("near"), np.uint8, parts, had)
                low = _values(batch.column("low"), np.float32, parts, had + 1)
                states = [
                    Bounds(entry[:, p], upper[:, p], near[:, p], low[:, p]).shrunk(b).moved(books.moves[p])
                    for p in range(parts)
                ]
            error = np.zeros(n, np.int64)
            for p, state in enumerate(states):
                before = state.entry.copy()
                depth = state.assign(x[:, p], books.entries[p])
                depths += np.bincount(depth, minlength=b + 2)
                changed = np.flatnonzero(state.entry != before) if not first else np.arange(n)
                np.add.at(sums[p], state.entry[changed], x[changed, p])
                np.add.at(counts[p], state.entry[changed], 1)
                if not first:
                    np.subtract.at(sums[p], before[changed], x[changed, p])
                    np.subtract.at(counts[p], before[changed], 1)
                if last:
                    error += ((x[:, p] - books.entries[p][state.entry]) ** 2).sum(1)
            entry = np.stack([s.entry for s in states], axis=1)
            if last:
                codes = [bytes(e).hex() for e in entry]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("label"), pa.array(codes, pa.string()),
                     pa.array(error, pa.int64())],
                    names=["id", "label", "code", "error"],
                )
                continue
            out = pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), kept_x, _binary(entry),
                 _binary(np.stack([s.upper for s in states], axis=1)),
                 _binary(np.stack([s.near for s in states], axis=1)),
                 _binary(np.stack([_ordered(s.low) for s in states], axis=1)),
                 pa.nulls(n, pa.list_(pa.int64()))],
                names=["id", "label", "x", "entry", "upper", "near", "low", "sums"],
            )
            schema = out.schema
            yield out
        if schema is not None:
            total = np.concatenate([sums.ravel(), counts.ravel(), depths])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, f.type) for f in schema][:-1] + [pa.array([total], pa.list_(pa.int64()))],
                schema=schema,
            )

    return of


def _kept(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """id, label and x of vectors that have components, none of them NULL or non-finite."""
    given = vectors.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").alias("label"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("x"),
    )
    return given.where(
        "x is not null and size(x) > 0 and forall(x, c -> c is not null and not isnan(c) and abs(c) < double('inf'))"
    )


def _added(rows: DataFrame) -> np.ndarray:
    """The sums of all tasks; as many numbers as the codebooks and the lists have."""
    places = rows.where("sums is not null").select(F.posexplode("sums").alias("place", "value"))
    found = places.groupBy("place").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(found), np.int64)
    for r in found:
        out[r["place"]] = r["value"]
    return out


def encode(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """(id, label, code, error) of every vector, and the final codebooks (part, entry, position).

    Components become floor(scale * x); vectors are cut into `parts` equal parts. Codebooks start
    as the parts of the `entries` smallest ids (NULL last; rows of equal id by their vectors), or of
    all if there are fewer. Each round assigns all parts to their nearest entries, ties to the lower
    index, and replaces used entries by the floored means of their parts. `code` has two hexadecimal
    digits for each part, `error` is the sum of squared distances.

    Rows whose vector is NULL, empty or holds NULL or non-finite components are left out. All others must
    have one length that `parts` divides and components below some 10^8 / scale, which keeps
    distances exact; else it is an error. Repeated rows count as often as they occur; an empty table
    has no codes and empty codebooks. Further columns are not read.

    A round reads the staged state of the last, writes its own, and removes the other when it is
    complete. Only sums of the size of the codebooks reach the driver.
    """
    spark = vectors.sparkSession
    common.prepare(spark)
    kept = _kept(vectors, id_column, vector_column, label_column)
    kinds = f"id {kept.schema['id'].dataType.simpleString()}, label {kept.schema['label'].dataType.simpleString()}"
    sizes = [r["n"] for r in kept.select(F.size("x").alias("n")).distinct().limit(2).collect()]
    if not sizes:
        return spark.createDataFrame([], f"{kinds}, code string, error long"), np.zeros((parts, 0, 0), np.int64)
    if len(sizes) > 1 or sizes[0] % parts:
        raise ValueError(f"vectors need one length that {parts} divides")
    size = sizes[0]

    def fresh(column: pa.Array) -> np.ndarray:
        return _integers(column, size, scale, parts)

    start = kept.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    first = _integers(pa.array([r["x"] for r in start], pa.list_(pa.float64())), size, scale, parts)
    books = Codebooks(first.astype(np.int64).transpose(1, 0, 2), np.zeros((parts, len(start))))
    k = len(start)
    had = b = min(max(k // 4, 1), k - 1)
    least = max(k // 8, 1)
    sums = np.zeros(books.shape, np.int64)
    counts = np.zeros((parts, k), np.int64)
    rows, old = kept, None
    for number in range(rounds):
        path = fresh_path(spark, f"codes-{number}")
        state = rows.mapInArrow(
            _round(books, number == 0, had, b, fresh, False), f"{kinds}, {_STATE}, sums array<long>"
        )
        state.write.parquet(path)
        written = spark.read.schema(state.schema).parquet(path)
        if old:
            fs, p = file_system(spark, old)
            fs.delete(p, True)
        change = _added(written)
        sums += change[:sums.size].reshape(sums.shape)
        counts += change[sums.size:sums.size + counts.size].reshape(counts.shape)
        books = books.next(sums, counts)
        # Lists as long as the deepest look that they settled; the first round had none.
        depths = change[sums.size + counts.size:]
        had = b
        if number:
            b = min(b, max([least, *np.flatnonzero(depths[:-1]).tolist()]))
        rows, old = written.where("sums is null").drop("sums"), path
    codes = stage(
        rows.mapInArrow(
            _round(books, old is None, had, b, fresh, True), f"{kinds}, code string, error long"
        ),
        "codes",
    )
    if old:
        fs, p = file_system(spark, old)
        fs.delete(p, True)
    return codes, books.entries


def with_label_errors(codes: DataFrame) -> DataFrame:
    """`codes` with label_error, the errors added up over equal labels; NULL equals NULL.

    Labels are added up before the shuffle, and the rows of frequent labels are spread.
    """
    sums = stage(
        codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors"
    )
    return left_lookup(codes, sums, {"label": "label"}, null_safe=True, floor=0)


def digest(entries: np.ndarray) -> str:
    """SHA-256 of the codebooks' integers in decimal, joined by commas."""
    return Codebooks(entries, np.zeros(0)).digest()
