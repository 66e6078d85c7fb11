"""Benchmark decontamination: size-partitioned MinHash containment search.

Documents are partitioned by the size of their shingle set. A partition with sets of up to x
shingles uses one-permutation MinHash with as many bins as its size needs, so that an item's
smallest shingle of a bin is almost surely the document's smallest too, if the document holds it.
An item is sketched once for each partition's number of bins, by its smallest hashes: as a document
that holds it lacks at most a share of its shingles, so many smallest ones and a few more can't all
be missing. A document and an item that agree in any such bin are a candidate pair, and an exact
count of common shingles, made for candidates only, decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import hot_keys
from ..session import stage
from . import common
from .tokens import grams, words

#: Bins for each shingle of the largest set of a partition, as a power of two. A shingle that both
#: sides hold is hidden in its bin with a chance of less than 2 ** -(SPARE_BITS + 1).
SPARE_BITS = 16
#: Smallest hashes of an item beyond those a document that holds it may lack. At least one more than so
#: many are in the document, all of which would have to be hidden for the pair to be missed.
EXTRA = 3
#: Partitions hold sets of up to 2, 4, 8 .. shingles; the last holds all larger ones, too.
CLASSES = 40
#: The filter that is sent to all tasks has some 16 bits for each item shingle, as a power of two, but
#: never more than 2 ** 27 bits, 16 MB, however large the benchmark.
FILTER_BITS = (16, 27)
#: Shares into which the documents that hold one frequent shingle are split.
SALTS = 16
#: Bytes of text whose shingles are hashed at once; a longer text is hashed alone.
SLICE = 2 << 20


def size_class(n: int) -> int:
    return min(max(n - 1, 1).bit_length(), CLASSES)


def sketch(hashes: np.ndarray, size: int) -> np.ndarray:
    """The places of the smallest hash of each bin, with the bins that sets of class `size` use."""
    order = np.argsort(hashes, kind="stable")
    bins = hashes[order] >> np.uint64(64 - min(size + SPARE_BITS, 63))
    return order[np.r_[True, bins[1:] != bins[:-1]]] if len(order) else order


def _shingle_rows(column: pa.Array, n: int, chosen=None) -> Iterator[tuple]:
    """(row, hashes, digests of the shingles, places) of each text that has words.

    Hashes (64 bits) are distinct; shingles are told by digests of 128 bits. `chosen` marks the hashes of interest: texts without any are passed over,
    and places are those of the others' marked hashes; without it, of all.
    """
    found = words(column)
    runs = grams(found.hash, n)
    marked = None if chosen is None else chosen(runs)
    for row in range(len(column)):
        a, b = int(found.first[row]), int(found.first[row + 1])
        if a == b:
            continue
        length = min(n, b - a)
        own = runs[a:b - n + 1] if length == n else grams(found.hash[a:b], length)
        if chosen is not None and not (marked[a:b - n + 1] if length == n else chosen(own)).any():
            continue
        hashes, at = np.unique(own, return_index=True)
        places = np.arange(len(hashes)) if chosen is None else np.flatnonzero(chosen(hashes))
        texts = (found.text(a + int(at[i]), a + int(at[i]) + length) for i in places)
        yield row, hashes, [xxhash.xxh128_digest(t) for t in texts], places


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about SLICE bytes of text, since the hashes of words take several times that."""
    for batch in batches:
        ends = np.cumsum(pa.compute.binary_length(batch.column("text")).fill_null(0).to_numpy())
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = max(int(np.searchsorted(ends, before + SLICE)), at + 1)
            yield batch.slice(at, end - at)
            at = end


def _table(column: pa.Array, rows: list[int], **others) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [column.take(pa.array(rows, pa.int64())), *others.values()], names=["id", *others]
    )


def _item_shingles(n: int):
    """A row for each item and shingle: its hash, and the classes in whose sketches it is."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            ids, texts, all_classes, own = [], [], [], []
            for row, hashes, shingles, _ in _shingle_rows(batch.column("text"), n):
                classes = np.zeros(len(hashes), np.int64)
                for size in range(1, CLASSES + 1):
                    classes[sketch(hashes, size)] |= 1 << size
                ids += [row] * len(hashes)
                texts += shingles
                all_classes.append(classes)
                own.append(hashes.astype(np.int64))
            yield _table(
                batch.column("id"), ids, shingle=pa.array(texts, pa.binary()),
                classes=pa.array(np.concatenate([*all_classes, np.zeros(0, np.int64)])),
                hash=pa.array(np.concatenate([*own, np.zeros(0, np.int64)])),
            )

    return rows


def _document_shingles(n: int, bits: np.ndarray):
    """Per document, the shingles that pass the filter, its size class, and if its sketch has them."""

    def passes(hashes: np.ndarray) -> np.ndarray:
        at = (hashes & np.uint64(8 * len(bits) - 1)).astype(np.int64)
        return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            ids, texts, classes, sketched = [], [], [], []
            for row, hashes, shingles, places in _shingle_rows(batch.column("text"), n, passes):
                size = size_class(len(hashes))
                inside = np.zeros(len(hashes), bool)
                inside[sketch(hashes, size)] = True
                ids += [row] * len(places)
                texts += shingles
                classes += [size] * len(places)
                sketched += inside[places].tolist()
            yield _table(
                batch.column("id"), ids, shingle=pa.array(texts, pa.binary()),
                size_class=pa.array(classes, pa.int32()), sketched=pa.array(sketched, pa.bool_()),
            )

    return rows


def _filter(items: DataFrame) -> np.ndarray:
    """A bitmap of the hashes of all item shingles, combined by Spark."""
    low, high = FILTER_BITS
    power = min(max((16 * items.count()).bit_length(), low), high)
    at = F.col("hash").bitwiseAND((1 << power) - 1)
    words = items.groupBy(F.floor(at / 32).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(hash & 31 as int))")).alias("bits")
    ).toArrow()
    bits = np.zeros(1 << (power - 5), np.uint32)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return bits.view(np.uint8)


def _met(many: DataFrame, few: DataFrame, key: str) -> DataFrame:
    """Inner join on `key`. Where it is frequent in `many`, its documents are spread over SALTS tasks."""
    frequent = F.col(key).isin([k[0] for k in hot_keys(many, [key])])
    spread = F.when(frequent, F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    copies = F.when(frequent, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return many.withColumn("salt", spread).join(few.withColumn("salt", F.explode(copies)), [key, "salt"])


def contained(
    docs: DataFrame, items: DataFrame, shingle: int = 5, threshold: float = 0.8,
    id_column: str = "doc_id", item_column: str = "item_id",
) -> DataFrame:
    """doc, item, common, size and containment for each document that holds an item.

    An item is held if at least `threshold` of its distinct word shingles are in the document. Words
    are compared in lower case (A-Z). A text of fewer words is one shingle; NULL and empty texts
    hold nothing and are held by nothing, and empty tables on either side give no pairs. Rows with
    the same id are one document, or item, with the shingles of all; rows without an id are left
    out, as no pair could name them. Shares equal to `threshold` are enough. A text of any length is
    read whole by the task that has its row; only those of its shingles that pass the items' filter
    go further. Further columns are not read.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    given = common.id_and_text(docs, id_column, "text").where("id is not null")
    tests = common.id_and_text(items, item_column, "text").where("id is not null")
    kind, item_kind = (t.schema["id"].dataType.simpleString() for t in (given, tests))
    tests = stage(
        tests.mapInArrow(
            _item_shingles(shingle), f"id {item_kind}, shingle binary, classes long, hash long"
        ).withColumnRenamed("id", "item"), "items",
    )
    tests = tests.groupBy("item", "shingle").agg(
        F.bit_or("classes").alias("classes"), F.first("hash").alias("hash")
    )
    own = Window.partitionBy("item")
    lacking = F.floor((1 - threshold) * F.col("size") + 1e-9)
    tests = stage(
        tests.withColumns(
            {"size": F.count("*").over(own), "rank": F.row_number().over(own.orderBy("hash", "shingle"))}
        ).withColumn("leads", F.col("rank") <= lacking + 1 + EXTRA), "sized",
    )
    found = stage(
        given.mapInArrow(
            _document_shingles(shingle, _filter(tests)),
            f"id {kind}, shingle binary, size_class int, sketched boolean",
        ).withColumnRenamed("id", "doc"), "found",
    )

    # Candidates: an equal value in a bin of the document's class.
    bins = found.where("sketched").select("doc", "shingle", "size_class")
    values = tests.where("leads").select("item", "shingle", "classes", "size")
    candidates = stage(
        _met(bins, values, "shingle").where("(shiftright(classes, size_class) & 1) = 1")
        .select("doc", "item", "size").distinct(), "candidates",
    )
    # The exact count, by document and shingle: no shingle is frequent there.
    met = _met(candidates, tests.select("item", "shingle"), "item").join(
        found.select("doc", "shingle").distinct(), ["doc", "shingle"]
    ).groupBy("doc", "item", "size").agg(F.count("*").alias("common"))
    return met.where(F.col("common") >= threshold * F.col("size")).select(
        "doc", "item", "common", "size", (F.col("common") / F.col("size")).alias("containment")
    )


def clean(docs: DataFrame, items: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of `docs` that hold none of `items`, in all their columns."""
    bad = contained(docs, items, shingle, threshold).select(F.col("doc").alias("doc_id")).distinct()
    return docs.join(bad, "doc_id", "left_anti")
