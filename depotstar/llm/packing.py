"""Best-fit packing with certified bounds.

Documents become pieces of at most `capacity` tokens. Partitions of bounded size pack their pieces
best-fit decreasing, and dual-feasible functions bound from below how many sequences any packing
of them needs. Partitions above their bound have gaps: they exchange the pieces of sequences that
are not full, and pack those again.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import common

#: Distinct words a worker remembers.
_REMEMBERED = 300_000


class Tokenizer:
    """Token ids by a byte-level BPE file of the `tokenizers` library.

    Text is cut before single blanks between other characters, where no token crosses, and the ids
    of frequent parts are remembered. Unknown parts go through `tiktoken` with the file's own
    vocabulary, which merges alike and faster; whatever may hold a special token goes to
    `tokenizers` itself, and so does a text with two blanks in a row.
    """

    _made: dict[str, Tokenizer] = {}

    @classmethod
    def at(cls, path: str) -> Tokenizer:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        import re

        import tiktoken
        import tokenizers

        self.whole = tokenizers.Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        specials = [t["content"] for t in described.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, specials)) or "(?!)")
        self.blanks = re.compile(r"\s\s")
        # The printable stand-ins of bytes in byte-level vocabularies.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        ranks = {
            bytes(byte[c] for c in piece): i
            for piece, i in described["model"]["vocab"].items() if piece not in specials
        }
        pattern = (
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        )
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def part(self, text: str) -> bytes:
        ids = np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        if len(self.known) < _REMEMBERED:
            self.known[text] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the text, without an end."""
        if self.special.search(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if self.blanks.search(text):
            return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        words = text.split(" ")
        words[1:] = [" " + w for w in words[1:]]
        known, part = self.known.get, self.part
        return b"".join([known(w) or part(w) for w in words if w])


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: full ones, but for the first if need be."""
    first = (length - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def _pieces_of(path: str, capacity: int, end: int):
    tail = np.array([end], "<u4").tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer.at(path)
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for r, text in enumerate(batch.column("text").to_pylist()):
                ids = tokenizer.ids(text) + tail
                for i, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                    row.append(r)
                    piece.append(i)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(ids[4 * s:4 * (s + n)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 *(pa.array(c, pa.int64()) for c in (start, length, crc))],
                names=["id", "piece", "start", "length", "ids_crc32"],
            )

    return rows


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end: int = 0) -> DataFrame:
    """id, piece, start, length and ids_crc32 of each piece of each row of `docs`."""
    common.prepare(docs.sparkSession)
    given = common.id_and_text(docs, "doc_id", "text")
    return given.mapInArrow(
        _pieces_of(tokenizer_path, capacity, end),
        f"id {given.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long",
    )


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, taken in decreasing order into the fullest bin that has room."""
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room
    rooms = 0  # bit r: a bin with room r is open
    n = 0
    for at in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[at])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            own = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, own = capacity, n
            n += 1
        bins[at], offsets[at] = own, capacity - room
        if room > size:
            open_bins[room - size].append(own)
            rooms |= 1 << (room - size)
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing needs fewer bins: the best of a family of dual-feasible functions.

    For k and e, lengths below e count nothing and lengths above capacity - e count full; the rest
    of length x counts floor((k + 1) x) / k of a bin, or x itself if (k + 1) x is whole. Sums are
    whole numbers, so the bound is exact.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1)
    size = np.arange(capacity + 1)
    best = -(-int((count * size).sum()) // capacity)
    for k in [0, *range(1, 13)]:
        if k:
            whole = (k + 1) * size % capacity == 0
            value = np.where(whole, size * k, (k + 1) * size // capacity * capacity)
        else:
            k, value = 1, size
        full = k * capacity
        ends = np.r_[0, np.cumsum(count * value)]
        above = np.r_[np.cumsum(count[::-1])[::-1], 0]
        e = np.arange(0, capacity // 2 + 1)
        # sizes in [e, capacity - e] by value, larger ones as full
        sums = ends[capacity - e + 1] - ends[e] + above[capacity - e + 1] * full
        best = max(best, -(-int(sums.max()) // full))
    return best


_PACKED = "uid long, part long, bin long, offset long, length long, fill long, bound long, bins long"


def _pack(capacity: int):
    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["length"].to_numpy(np.int64)
        bins, offsets = best_fit(lengths, capacity)
        fill = np.bincount(bins, lengths, minlength=1).astype(np.int64)
        return pd.DataFrame({
            "uid": rows["uid"], "part": rows["part"], "bin": bins, "offset": offsets, "length": lengths,
            "fill": fill[bins], "bound": lower_bound(lengths, capacity), "bins": int(bins.max()) + 1,
        })

    return packed


def _partition_and_pack(rows: DataFrame, n: int, per_partition: int, turn: int, capacity: int) -> DataFrame:
    parts = max(1, -(-n // per_partition))
    part = F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(parts)).alias("part")
    done = rows.select("uid", "length", part).groupBy("part").applyInPandas(_pack(capacity), _PACKED)
    return stage(done.withColumn("turn", F.lit(turn)), f"packed{turn}")


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end: int = 0,
    per_partition: int = 100_000, turns: int = 3,
) -> DataFrame:
    """Each piece of `docs` (doc_id, text) with its sequence and place there.

    doc_id, piece (from 0), start (the document's ids before it), length, ids_crc32 (of unsigned
    little-endian 32-bit ids), sequence_id and offset. Each row of `docs` is tokenized whole and
    closed with the id `end`; a NULL text counts as empty and is one token long. Only documents
    above `capacity` are cut. Rows with equal or NULL doc_id are packed one by one.

    In each of at most `turns` exchanges, partitions above their bound give the pieces of their
    sequences that are not full, and every partition those of its emptiest one; these are dealt
    anew and packed again. The exchange is kept if it saves sequences, and is the last if not.
    """
    rows = stage(
        pieces(docs, tokenizer_path, capacity, end).withColumn("uid", F.monotonically_increasing_id()),
        "pieces",
    )
    settled: list[DataFrame] = []
    pool, n = rows.select("uid", "length"), rows.count()
    packed = _partition_and_pack(pool, n, per_partition, 0, capacity)
    for turn in range(1, turns + 1):
        per_part = packed.groupBy("turn", "part").agg(F.max("bound").alias("b"), F.max("bins").alias("m"), F.min("fill").alias("least"))
        gaps = packed.join(per_part, ["turn", "part"])
        gives = "fill < {0} and (m > b or fill = least)".format(capacity)
        given = stage(gaps.where(gives).select(*packed.columns), "given")
        size = given.agg(F.count("*"), F.countDistinct("turn", "part", "bin")).first()
        if not size[0]:
            break
        again = _partition_and_pack(given.select("uid", "length"), size[0], per_partition, turn, capacity)
        if again.select("turn", "part", "bin").distinct().count() >= size[1]:
            break
        settled.append(gaps.where(f"not ({gives})").select(*packed.columns))
        packed = again
    for more in settled:
        packed = packed.unionByName(more)
    sequence = F.expr("shiftleft(cast(turn as bigint), 58) + shiftleft(part, 20) + bin")
    return rows.join(packed.select("uid", sequence.alias("sequence_id"), "offset"), "uid").select(
        F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
