"""Substring deduplication by content-defined chunks.

A gear rolling hash over the last 16 bytes decides where chunks end, so an insertion moves only the
cuts beside it; equal passages give equal chunks wherever they stand. Chunks are deduplicated by
a 128-bit digest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from . import common

_GEAR = np.random.default_rng(5).integers(0, 1 << 32, 256, np.uint32)
WINDOW = 16


def gear(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of gear(byte i - j) * 2 ** j over the last 16 bytes, modulo 2 ** 32."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        h[step:] += h[:-step] << np.uint32(step)
    return h


def cuts(text: bytes, least: int, mask_bits: int, most: int) -> list[int]:
    """Ends of the chunks of a text, in bytes, at whole characters.

    A chunk ends where the hash says so, after at least `least` bytes, or after `most`.
    """
    n = len(text)
    if n <= least:
        return [n] if n else []
    data = np.frombuffer(text, np.uint8)
    opens = np.append(data[1:] & 0xC0 != 0x80, True)
    wanted = (gear(data) >> np.uint32(WINDOW)) & np.uint32((1 << mask_bits) - 1) == 0
    ends = (np.flatnonzero(wanted & opens) + 1).tolist()
    out, last, at = [], 0, 0
    while last < n:
        while at < len(ends) and ends[at] < last + least:
            at += 1
        end = min(ends[at] if at < len(ends) else n, last + most, n)
        while end < n and not opens[end - 1]:
            end += 1
        out.append(end)
        last = end
    return out


def _chunks_of(least: int, mask_bits: int, most: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, number, start, length, digest = [], [], [], [], []
            for r, text in enumerate(common.text_bytes(batch)):
                ends = cuts(text, least, mask_bits, most)
                if not ends:
                    continue
                chars = np.cumsum(np.frombuffer(text, np.uint8) & 0xC0 != 0x80)
                at = np.r_[0, chars[np.array(ends) - 1]]
                row += [r] * len(ends)
                number += range(len(ends))
                start.append(at[:-1])
                length.append(np.diff(at))
                digest += [
                    xxhash.xxh128_digest(text[a:b]) for a, b in zip([0, *ends], ends)
                ]
            none = [np.zeros(0, np.int64)]
            rows = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(rows), batch.column("uid").take(rows),
                 pa.array(number, pa.int32()), pa.array(np.concatenate(start + none), pa.int64()),
                 pa.array(np.concatenate(length + none), pa.int32()), pa.array(digest, pa.binary())],
                names=["id", "uid", "number", "start", "length", "digest"],
            )

    return rows


def chunks(docs: DataFrame, least: int = 24, mask_bits: int = 5, most: int = 512) -> DataFrame:
    """id, uid (one for each row of `docs`), number, start and length in characters, and digest."""
    common.prepare(docs.sparkSession)
    given = common.id_and_text(docs, "doc_id", "text").withColumn("uid", F.monotonically_increasing_id())
    return given.mapInArrow(
        _chunks_of(least, mask_bits, most),
        f"id {given.schema['id'].dataType.simpleString()}, uid long, number int, start long, "
        "length int, digest binary",
    )


def repeated(docs: DataFrame, least: int = 24, mask_bits: int = 5, most: int = 512) -> DataFrame:
    """Every occurrence of a chunk that occurs more than once, with its copies and the first of them.

    The first is that of the smallest doc_id (NULL last), row and start; all others can go.
    """
    found = stage(chunks(docs, least, mask_bits, most), "chunks")
    first = F.struct(F.col("id").isNull().alias("unnamed"), "id", "uid", "start")
    copies = found.groupBy("digest").agg(
        F.count("*").alias("copies"), F.min(first).alias("first")
    ).where("copies > 1")
    return found.join(copies, "digest").withColumn(
        "is_first", F.expr("first.uid = uid and first.start = start")
    ).drop("digest")


def repeated_spans(
    docs: DataFrame, least_chars: int = 72, least: int = 24, mask_bits: int = 5, most: int = 512
) -> DataFrame:
    """Passages of at least `least_chars` characters made of repeated chunks that follow each other.

    A passage takes in all repeated chunks that touch, whichever of them occurred here first; its
    length decides. It comes out in parts whose chunks are all the first of their kind (kept) or all
    not: doc_id, start and end of the part (characters, end exclusive), kept, copies (the most of any
    of its chunks), first_doc_id (that of the first occurrence of its first chunk), passage_start and
    passage_end. Taking out the parts that are not kept leaves every chunk once.

    A NULL text counts as empty and has no chunks; an empty table has no passages. Rows with equal or
    NULL doc_id are texts of their own; of equal chunks the one in the smallest doc_id, then row, then
    place is the first. A text of any length is cut whole; its repeated chunks, not their texts, are
    brought to one task. Further columns are not read.
    """
    found = repeated(docs, least, mask_bits, most)
    place = Window.partitionBy("uid").orderBy("number")
    gap = F.coalesce(F.col("number") != F.lag("number").over(place) + 1, F.lit(True))
    turn = gap | (F.col("is_first") != F.lag("is_first").over(place))
    parts = (
        found.withColumns({"gap": gap.cast("int"), "turn": turn.cast("int")})
        .withColumns({"run": F.sum("gap").over(place), "part": F.sum("turn").over(place)})
        .groupBy("uid", "run", "part").agg(
            F.first("id").alias("doc_id"), F.min("start").alias("start"),
            F.max(F.col("start") + F.col("length")).alias("end"), F.first("is_first").alias("kept"),
            F.max("copies").alias("copies"), F.min_by("first.id", "number").alias("first_doc_id"),
        )
    )
    whole = Window.partitionBy("uid", "run")
    return (
        parts.withColumns(
            {"passage_start": F.min("start").over(whole), "passage_end": F.max("end").over(whole)}
        )
        .where(F.col("passage_end") - F.col("passage_start") >= least_chars)
        .select("doc_id", "start", "end", "kept", "copies", "first_doc_id", "passage_start", "passage_end")
    )
