"""Embedding near-duplicates: Euclidean p-stable hashing with exact cosine checks.

A table's key is k quantised projections floor((a.v + b) / w) of the normalised vector; vectors
that share a key in any of the tables are compared. Equal vectors are hashed once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import common
from .components import components

WIDTH = 1.5


def _collides(distance: float, width: float = WIDTH) -> float:
    """Chance that one quantised projection agrees for two vectors so far apart."""
    r = width / distance
    normal = 0.5 * (1 + math.erf(-r / math.sqrt(2)))
    return 1 - 2 * normal - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


@dataclass(frozen=True)
class Tables:
    """k projections in each of n tables, drawn from `seed`."""

    k: int
    n: int
    seed: int = 7

    @staticmethod
    def fitting(rows: int, cosine: float, recall: float = 0.995, chance: int = 50) -> Tables:
        """Tables that find a pair at the threshold with chance `recall`.

        k grows with the logarithm of the rows, so that a vector meets about `chance` unrelated
        ones (at right angles) in a table, whatever their number.
        """
        far, near = _collides(math.sqrt(2)), _collides(math.sqrt(2 - 2 * cosine))
        k = max(1, math.ceil(math.log(max(rows / chance, 1)) / -math.log(far)))
        return Tables(k, math.ceil(math.log(1 - recall) / math.log(1 - near**k)))

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """A 32-bit key for each vector and table."""
        random = np.random.default_rng([self.seed, unit.shape[1]])
        a = random.standard_normal((unit.shape[1], self.n * self.k))
        b = random.uniform(0, WIDTH, self.n * self.k)
        steps = np.floor((unit @ a + b) / WIDTH).astype(np.int64).reshape(len(unit), self.n, self.k)
        mixed = np.full((len(unit), self.n), unit.shape[1], np.uint64)
        for i in range(self.k):
            mixed = (mixed ^ steps[:, :, i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return (mixed >> np.uint64(32)).astype(np.uint32).astype(np.int32)


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Divided by the largest component first, so that squares neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, digest and bytes (doubles) of each vector; both NULL where it can't be compared."""
    for batch in batches:
        digests, payloads = [], []
        for v in batch.column("v"):
            values = None if not v.is_valid else v.values
            payload = None
            if values is not None and len(values) and not values.null_count:
                x = np.asarray(values, np.float64)
                if np.isfinite(x).all() and x.any():
                    payload = (x + 0.0).tobytes()
            payloads.append(payload)
            digests.append(payload and xxhash.xxh128_digest(payload))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(digests, pa.binary()), pa.array(payloads, pa.binary())],
            names=["id", "digest", "v"],
        )


def _keys(tables: Tables):
    """A row for each vector and table."""

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for _, same in part.groupby(part["v"].map(len)):
                for at in range(0, len(same), 256):
                    some = same.iloc[at:at + 256]
                    unit = _unit(np.stack([np.frombuffer(v) for v in some["v"]]))
                    codes = tables.codes(unit)
                    packed = [c.tobytes() for c in codes]
                    bytes_ = [u.tobytes() for u in unit]
                    for t in range(tables.n):
                        yield pd.DataFrame({
                            "t": t, "code": codes[:, t], "digest": some["digest"].to_numpy(),
                            "n": some["n"].to_numpy(), "codes": packed, "unit": bytes_,
                        })

    return rows


_FOUND = "digest binary, n_links long, root binary"


def _compare(cosine: float):
    """Links within the cells of a bundle: how many each vector has, and a star for each group.

    A pair that meets in several tables counts in the first of them only. A vector may come out once
    for each of its cells.
    """

    def compared(part: pd.DataFrame) -> pd.DataFrame:
        digests, counts, roots = [], [], []
        for _, own in part.groupby(part["unit"].map(len)):
            own = own.sort_values(["t", "code", "ci", "cj", "side"], kind="stable")
            unit = np.frombuffer(b"".join(own["unit"])).reshape(len(own), -1)
            codes = np.frombuffer(b"".join(own["codes"]), np.int32).reshape(len(own), -1)
            digest, n, t, side = (own[c].to_numpy() for c in ("digest", "n", "t", "side"))
            cell = own[["t", "code", "ci", "cj"]].to_numpy()
            cuts = np.flatnonzero((cell[1:] != cell[:-1]).any(1)) + 1
            for a, z in zip(np.r_[0, cuts], np.r_[cuts, len(own)]):
                # In a cell of two blocks, those of the first meet those of the second.
                diagonal = cell[a, 2] == cell[a, 3]
                middle = a if diagonal else a + np.searchsorted(side[a:z], 1)
                left = slice(a, z) if diagonal else slice(a, middle)
                i, j = np.nonzero(unit[left] @ unit[middle:z].T >= cosine)
                i, j = i + a, j + middle
                if diagonal:
                    i, j = i[i < j], j[i < j]
                if not len(i):
                    continue
                known = np.zeros(len(i), bool)
                for earlier in range(t[a]):
                    known |= codes[i, earlier] == codes[j, earlier]
                i, j = i[~known] - a, j[~known] - a
                links, group = np.zeros(z - a, np.int64), np.arange(z - a)
                np.add.at(links, i, n[a + j])
                np.add.at(links, j, n[a + i])
                while len(i) and (group[i] != group[j]).any():
                    np.minimum.at(group, i, group[j])
                    np.minimum.at(group, j, group[i])
                some = np.flatnonzero(links)
                digests += digest[a + some].tolist()
                counts += links[some].tolist()
                roots += digest[a + group[some]].tolist()
        return pd.DataFrame({"digest": digests, "n_links": counts, "root": roots})

    return compared


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.95, id_column: str = "vec_id",
    vector_column: str = "embedding", recall: float = 0.995, block: int = 1000,
    bundle: int = 20_000,
) -> DataFrame:
    """id, n_links and component_id of each row of `vectors`.

    Vectors are linked if their cosine in double precision is at least `cosine`; of the pairs just
    at it, the share `recall` is found, and more of the nearer ones. n_links counts the other rows
    linked directly, repeated rows and equal vectors included; component_id is the smallest id
    reached by links. A vector that is NULL, empty or zero, or has NULL or non-finite components,
    links with nothing, and neither does one of another length or without an id. Further columns
    are not read.

    A bucket of more than `block` vectors is cut into blocks, and each pair of blocks is a cell of
    its own. Cells are dealt out in bundles of some `bundle` vectors; links are counted there, and no
    pair leaves it.
    """
    spark = vectors.sparkSession
    common.prepare(spark)
    given = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("v"),
    )
    rows = stage(given.mapInArrow(_digests, "id long, digest binary, v binary"), "vectors")
    rows = rows.withColumn("digest", F.when(F.col("id").isNotNull(), F.col("digest")))
    groups = stage(
        rows.where("digest is not null").groupBy("digest").agg(
            F.min("id").alias("least"), F.count("*").alias("n"), F.first("v").alias("v")
        ), "groups",
    )
    tables = Tables.fitting(groups.count(), cosine, recall)
    keyed = stage(
        groups.select("digest", "n", "v").repartition("digest").mapInPandas(
            _keys(tables), "t int, code int, digest binary, n long, codes binary, unit binary"
        ), "keys",
    )
    sizes = stage(
        keyed.groupBy("t", "code").agg(F.count("*").alias("m")).where("m > 1")
        .withColumn("blocks", F.ceil(F.col("m") / block).cast("int")), "sizes",
    )
    rows_in_cells = sizes.agg(F.sum(F.col("m") * F.col("blocks"))).first()[0] or 0
    bundles = -(-rows_in_cells // bundle) or 1
    cells = (
        keyed.join(sizes.select("t", "code", "blocks"), ["t", "code"])
        .withColumn("own", F.pmod(F.xxhash64("digest"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "t", "code", F.least("own", "other").alias("ci"), F.greatest("own", "other").alias("cj"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
            "digest", "n", "codes", "unit",
        )
        .withColumn("bundle", F.pmod(F.xxhash64("t", "code", "ci", "cj"), F.lit(bundles)))
    )
    found = stage(cells.groupBy("bundle").applyInPandas(_compare(cosine), _FOUND), "found")
    near = found.groupBy("digest").agg(F.sum("n_links").alias("near"))
    joined = components(found.select(F.col("digest").alias("a"), F.col("root").alias("b")))
    named = groups.select("digest", "n", "least").join(
        joined.withColumnRenamed("node", "digest"), "digest", "left"
    ).withColumn("component", F.coalesce("component", "digest"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = named.join(smallest, "component").join(near, "digest", "left").select(
        "digest", (F.coalesce("near", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    return rows.select("id", "digest").join(classes, "digest", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
