"""SimHash near-duplicates, found by a pigeonring filter.

A fingerprint is cut into max_distance + 1 segments on a ring. If two fingerprints differ in at
most max_distance bits, then from some segment on, every chain of l consecutive segments differs in
at most l * max_distance / (max_distance + 1) bits. So the first segment is equal and the second
differs in one bit at most: both are put in the key of an equality join. Longer chains and then the
full distance are checked on what the key lets through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import common
from .components import components

BITS = 64
SEED = 42


def fingerprint(text: bytes, shingle: int) -> int:
    """The fingerprint as a signed 64-bit number; 0 for a text without words."""
    words = common.words_of(text)
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), np.uint64)
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    bits = (2 * set_bits > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits).view(">u8")[0].astype(np.int64))


def fingerprints(
    docs: DataFrame, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """id and fp (signed 64-bit) of each row; a NULL text counts as empty."""
    common.prepare(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in common.text_bytes(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(fps, pa.int64())], names=["id", "fp"]
            )

    given = common.id_and_text(docs, id_column, text_column)
    return given.mapInArrow(of, f"id {given.schema['id'].dataType.simpleString()}, fp long")


def _segments(max_distance: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment of the ring."""
    m = max_distance + 1
    cuts = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _segment(fp: str, shift: int, width: int) -> Column:
    return F.expr(f"shiftrightunsigned({fp}, {shift}) & {(1 << width) - 1}L")


def links(distinct_fps: DataFrame, max_distance: int) -> DataFrame:
    """Pairs (a, b) of different fingerprints of `distinct_fps` (fp) at most max_distance apart.

    A fingerprint has at most C(64, 1) + .. + C(64, max_distance) others so near, however many rows
    share them, so links grow with the number of fingerprints. A pair comes out once per way it
    passes the ring at most.
    """
    if max_distance == 0:
        return distinct_fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("a <> b")
    ring = _segments(max_distance)
    m = len(ring)
    index, probes = [], []
    for i in range(m):
        (shift, width), (shift2, width2) = ring[i], ring[(i + 1) % m]
        here, following = _segment("fp", shift, width), _segment("fp", shift2, width2)
        index.append(F.struct(F.lit(i).alias("i"), here.alias("s"), following.alias("t")))
        probes.append(F.struct(F.lit(i).alias("i"), here.alias("s"), following.alias("t"),
                               F.lit(False).alias("flipped")))
        # One end of a pair has the differing bit unset, and only that end asks with it set.
        probes += [
            F.when(
                following.bitwiseAND(F.lit(1 << bit)) == 0,
                F.struct(F.lit(i).alias("i"), here.alias("s"),
                         following.bitwiseOR(F.lit(1 << bit)).alias("t"),
                         F.lit(True).alias("flipped")),
            )
            for bit in range(width2)
        ]
    stored = distinct_fps.select(F.col("fp").alias("b"), F.explode(F.array(*index)).alias("k")).select(
        "b", "k.i", "k.s", "k.t"
    )
    asked = distinct_fps.select(
        F.col("fp").alias("a"), F.explode(F.filter(F.array(*probes), lambda p: p.isNotNull())).alias("k")
    ).select("a", "k.i", "k.s", "k.t", "k.flipped")
    differing = F.col("a").bitwiseXOR(F.col("b"))
    found = asked.join(stored, ["i", "s", "t"]).where(
        (F.col("flipped") | (F.col("a") < F.col("b"))) & (F.col("a") != F.col("b"))
        & _chains("i", differing, ring, max_distance)
        & (F.bit_count(differing) <= max_distance)
    )
    return found.select("a", "b")


def _chains(start: str, differing: Column, ring: list[tuple[int, int]], budget: int) -> Column:
    """Chains of three segments and more from `start` stay within their share of the budget."""
    m = len(ring)
    within = F.lit(True)
    for length in range(3, m):
        for i in range(m):
            mask = 0
            for j in range(length):
                shift, width = ring[(i + j) % m]
                mask |= ((1 << width) - 1) << shift
            mask -= (mask >> 63) << 64
            bits = F.bit_count(differing.bitwiseAND(F.lit(mask)))
            within &= (F.col(start) != i) | (bits <= length * budget // m)
    return within


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_distance: int = 2, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """id, fp and component_id of each row of `docs`.

    Rows whose fingerprints differ in at most `max_distance` bits are linked; component_id is the
    smallest id a row reaches by links. Texts without words share the fingerprint 0 and are linked
    like others. Rows with the same id are separate rows; a NULL id is never the smallest, so a
    group of such rows alone has a NULL component_id. Further columns are not read.
    """
    fps = stage(fingerprints(docs, shingle, id_column, text_column), "fingerprints")
    classes = stage(fps.groupBy("fp").agg(F.min("id").alias("first")), "classes")
    found = components(links(classes.select("fp"), max_distance))
    named = classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = named.join(least, "component").select("fp", "component_id")
    return fps.join(classes, "fp").select("id", "fp", "component_id")


def hexadecimal(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
