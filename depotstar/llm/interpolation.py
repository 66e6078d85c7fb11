"""Language-model scores by deleted interpolation.

log10 P of a text is summed over its tokens, with
P(w | h) = sum over orders k of lambda[b, k] f_k(w | h) + lambda[b, 0] / (V + 1),
where f_k are maximum-likelihood estimates and b is the bucket of the context's frequency. The
lambdas are learned by expectation-maximisation on a deleted part of the training documents, under
counts without that part; scores then use the counts of the whole training part.

Texts are encoded once in blocks. A block asks for the counts of its distinct n-grams, each once
however often it has it, so a frequent n-gram costs as many requests as there are blocks and no
task gathers its occurrences. Requests are split by ranges of the n-gram's hash; each range counts
on its own and answers the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import common
from .tokens import mix, words

END = np.uint64(0xA5B35705F39C2E17)
START = np.uint64(0x3C6EF372FE94F82B)
BLOCK_BYTES = 8 << 20
RANGE_KEYS = 1_000_000
BUCKETS = 40
#: A block's documents are all of one kind.
REST, HELD_OUT, DELETED = 0, 1, 2


def _planes(numbers: np.ndarray) -> bytes:
    """First all lowest bytes, then all second ones and so on: compresses well."""
    return numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def _from_planes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(size, -1).T.copy().view(kind).reshape(-1)


def _packed(numbers: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(3).compress(_planes(numbers))


def _unpacked(data: bytes, kind) -> np.ndarray:
    return _from_planes(zstandard.ZstdDecompressor().decompress(data), kind)


def _sorted_bytes(keys: np.ndarray) -> bytes:
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def _sorted_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(data, np.uint64), dtype=np.uint64)


# Encoded blocks.


def _encode(parts: list[pa.RecordBatch], block: int, kind: int) -> pa.RecordBatch:
    rows = pa.Table.from_batches(parts).combine_chunks()
    found = words(pa.concat_arrays(rows["text"].cast(pa.large_binary()).chunks))
    lengths = np.diff(found.first) + 1
    tokens = np.insert(found.hash, found.first[1:], END)
    vocabulary, places, counts = np.unique(tokens, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    ids = pa.concat_arrays(rows["id"].chunks)
    return pa.RecordBatch.from_arrays(
        [pa.array([block]), pa.array([kind], pa.int32()),
         pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
         pa.array([_packed(lengths.astype(np.uint32))], pa.binary()),
         pa.array([_sorted_bytes(vocabulary)], pa.binary()),
         pa.array([_packed(counts.astype(np.uint32))], pa.binary()),
         pa.array([_packed(rank[places])], pa.binary()), pa.array([len(tokens)])],
        names=["block", "kind", "ids", "lengths", "vocabulary", "counts", "stream", "tokens"],
    )


@dataclass
class Block:
    """Token hashes of a block's documents, one after the other; each ends with END."""

    tokens: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    @staticmethod
    def decoded(lengths: bytes, vocabulary: bytes, counts: bytes, stream: bytes) -> Block:
        sizes = _unpacked(lengths, np.uint32).astype(np.int64)
        order = np.argsort(-_unpacked(counts, np.uint32).astype(np.int64), kind="stable")
        tokens = _sorted_keys(vocabulary)[order][_unpacked(stream, np.uint32)]
        return Block(tokens, np.r_[0, np.cumsum(sizes)[:-1]], sizes)

    def grams(self, k: int) -> np.ndarray:
        """The hash of the k tokens that end at each place; before a document stands START."""
        if k == 1:
            return self.tokens
        into = np.arange(len(self.tokens)) - np.repeat(self.starts, self.lengths)
        out = np.full(len(self.tokens), np.uint64(k))
        for back in range(k - 1, -1, -1):
            token = np.roll(self.tokens, back)
            token[into < back] = START
            out = mix(out * np.uint64(0xD6E8FEB86659FD93) + token)
        return out


def _kinds(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("kind").to_numpy(zero_copy_only=False)


def _encoded(block_bytes: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        block = context.partitionId() << 32
        waiting: dict[int, list[pa.RecordBatch]] = {}
        held: dict[int, int] = {}
        for batch in batches:
            kinds = _kinds(batch)
            for kind in np.unique(kinds).tolist():
                own = batch.filter(pa.array(kinds == kind))
                waiting.setdefault(kind, []).append(own)
                held[kind] = held.get(kind, 0) + own.column("text").nbytes
                if held[kind] >= block_bytes:
                    yield _encode(waiting.pop(kind), block, kind)
                    held[kind], block = 0, block + 1
        for kind, parts in waiting.items():
            yield _encode(parts, block, kind)
            block += 1

    return rows


# Requests and answers.


def _requests(order: int, ranges: int):
    """For each block, order and range of hashes: the distinct n-grams and how many of each."""

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples():
                block = Block.decoded(r.lengths, r.vocabulary, r.counts, r.stream)
                for k in range(1, order + 1):
                    keys, counts = np.unique(block.grams(k), return_counts=True)
                    slot = _range_of(keys, ranges)
                    cuts = np.searchsorted(slot, np.arange(ranges + 1))
                    out = [
                        (r.block, r.kind, k, i, _sorted_bytes(keys[a:b]),
                         _planes(counts[a:b].astype(np.uint32)))
                        for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b
                    ]
                    yield pd.DataFrame(out, columns=["block", "kind", "k", "slot", "keys", "n"])

    return rows


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


_ANSWER = "block long, k int, slot int, total binary, deleted binary, distinct long"


def _answer(part: pd.DataFrame) -> pd.DataFrame:
    """Training counts of one range: all, and in the deleted part; the latter for its own blocks."""
    asked = [(_sorted_keys(k), _from_planes(n, np.uint32)) for k, n in zip(part["keys"], part["n"])]
    kinds = part["kind"].to_numpy()
    learned = [a for a, kind in zip(asked, kinds) if kind != HELD_OUT]
    empty = (np.zeros(0, np.uint64), np.zeros(0, np.uint32))
    keys = np.unique(np.concatenate([k for k, _ in [*learned, empty]]))
    total, deleted = np.zeros(len(keys) + 1, np.int64), np.zeros(len(keys) + 1, np.int64)
    for (own, n), kind in zip(asked, kinds):
        if kind != HELD_OUT:
            at = np.searchsorted(keys, own)
            total[at] += n
            if kind == DELETED:
                deleted[at] += n
    out = []
    for (own, _), kind in zip(asked, kinds):
        at = np.searchsorted(keys, own)
        known = at < len(keys)
        known[known] = keys[at[known]] == own[known]
        at[~known] = len(keys)
        out.append((
            _packed(total[at].astype(np.uint64)),
            _packed(deleted[at].astype(np.uint64)) if kind == DELETED else None,
        ))
    answers = part[["block", "k", "slot"]].copy()
    answers["total"] = [t for t, _ in out]
    answers["deleted"] = [d for _, d in out]
    answers["distinct"] = [len(keys), *[0] * (len(part) - 1)]
    return answers


def _counts_by_place(block: Block, order: int, answers: pd.DataFrame, column: str) -> list[np.ndarray]:
    """For k = 1 .. order, the count of the n-gram that ends at each token."""
    out = []
    for k in range(1, order + 1):
        _, places = np.unique(block.grams(k), return_inverse=True)
        own = answers[answers["k"] == k].sort_values("slot")
        counts = np.concatenate([_unpacked(c, np.uint64) for c in own[column]])
        out.append(counts.astype(np.float64)[places])
    return out


def _estimates(block: Block, counts: list[np.ndarray], documents: float, size: float) -> tuple[np.ndarray, np.ndarray]:
    """f_1 .. f_order of each token, and the frequency of its longest context."""
    f, context = [counts[0] / max(size, 1)], np.full(len(block.tokens), size)
    for shorter, longer in zip(counts, counts[1:]):
        context = np.r_[0.0, shorter[:-1]]
        context[block.starts] = documents  # nothing but the start of the document
        f.append(np.divide(longer, context, out=np.zeros_like(longer), where=context > 0))
    return np.array(f), context


def _bucket(context: np.ndarray) -> np.ndarray:
    """Contexts are bucketed by powers of two of their frequency; 0: never seen."""
    return np.minimum(np.ceil(np.log2(context + 1)), BUCKETS - 1).astype(np.int64)


# Mixture weights.


def _cells(order: int, documents: float, size: float, steps: int):
    """Deleted tokens by bucket and by rounded logarithms of their estimates, with sums of these."""
    schema = [*[f"q{k}" for k in range(1, order + 1)], "bucket", "n", *[f"f{k}" for k in range(1, order + 1)]]

    def cells(encoded: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in encoded.itertuples():
            block = Block.decoded(r.lengths, r.vocabulary, r.counts, r.stream)
            total, deleted = (_counts_by_place(block, order, answers, c) for c in ("total", "deleted"))
            rest = [t - d for t, d in zip(total, deleted)]
            f, context = _estimates(block, rest, documents, size)
            q = np.where(f > 0, np.round(steps * np.log2(np.where(f > 0, f, 1))), 1).astype(np.int64)
            key = _bucket(context)
            for row in q:
                key = key * 512 - row + 256
            _, first, cell, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            frame = {f"q{k}": q[k - 1][first] for k in range(1, order + 1)}
            frame |= {"bucket": _bucket(context)[first], "n": n}
            frame |= {f"f{k}": np.bincount(cell, f[k - 1]) for k in range(1, order + 1)}
            out.append(pd.DataFrame(frame))
        return pd.concat(out) if out else pd.DataFrame(columns=schema)

    kinds = ["int"] * order + ["int", "long"] + ["double"] * order
    return cells, ", ".join(f"{c} {t}" for c, t in zip(schema, kinds))


def learn_weights(n: np.ndarray, bucket: np.ndarray, f: np.ndarray, turns: int = 40) -> np.ndarray:
    """Expectation-maximisation: lambda[bucket, component] for n tokens with estimates f each.

    Buckets without deleted tokens keep equal weights. One token is added to each component, so
    that none vanishes.
    """
    weights = np.full((BUCKETS, len(f)), 1 / len(f))
    for _ in range(turns):
        share = weights[bucket].T * f
        share *= n / np.maximum(share.sum(0), 1e-300)
        gained = np.ones_like(weights)
        for c, row in enumerate(share):
            gained[:, c] += np.bincount(bucket, row, minlength=BUCKETS)
        weights = gained / gained.sum(1, keepdims=True)
    return weights


# Scores.


def _scores(order: int, weights: np.ndarray, documents: float, size: float, distinct: float, kind: str):
    def scores(encoded: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in encoded.itertuples():
            block = Block.decoded(r.lengths, r.vocabulary, r.counts, r.stream)
            counts = _counts_by_place(block, order, answers, "total")
            f, context = _estimates(block, counts, documents, size)
            w = weights[_bucket(context)].T
            p = w[0] / (distinct + 1) + (w[1:] * f).sum(0)
            base = np.log10((counts[0] + 0.5) / (size + 0.5 * (distinct + 1)))
            sums = (np.add.reduceat(v, block.starts) for v in (counts[0] > 0, base, np.log10(p)))
            known, base, score = sums
            out.append(pd.DataFrame({
                "id": list(r.ids), "held_out": r.kind == HELD_OUT, "n_tokens": block.lengths,
                "n_known": known.astype(np.int64), "base_score": base, "score": score,
            }))
        return pd.concat(out) if out else pd.DataFrame(
            columns=["id", "held_out", "n_tokens", "n_known", "base_score", "score"]
        )

    return scores, f"id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def score(
    docs: DataFrame, order: int = 2, folds: int = 5, held_out: int = 1, deleted: int = 2,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row.

    `docs` has doc_id and text. Tokens are the words (A-Z in lower case) and an end. Documents of
    the fold `held_out` are scored but not learned from; those of `deleted` teach the mixture
    weights. base_score smooths counts of single tokens by a half. A NULL text counts as empty; an
    empty one has its end only. Rows with equal doc_id are rows of their own, and a NULL doc_id is
    in fold 0. Without training documents every token is unknown. Further columns are not read.

    N-grams are told apart by 64-bit hashes. The driver gets at most one number for each cell of
    bucket and rounded estimates, whose number does not depend on the input.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    given = common.id_and_text(docs, "doc_id", "text")
    fold = common.fold("id", folds)
    kind = F.when(fold == held_out, HELD_OUT).when(fold == deleted, DELETED).otherwise(REST)
    id_type = given.schema["id"].dataType.simpleString()
    blocks = stage(
        given.withColumn("kind", kind.cast("int")).mapInArrow(
            _encoded(block_bytes),
            f"block long, kind int, ids array<{id_type}>, lengths binary, vocabulary binary, "
            "counts binary, stream binary, tokens long",
        ), "blocks",
    )
    totals = {
        r["kind"]: r for r in blocks.groupBy("kind").agg(
            F.sum("tokens").alias("tokens"), F.sum(F.size("ids")).alias("documents")
        ).collect()
    }
    tokens = {k: totals[k]["tokens"] if k in totals else 0 for k in (REST, HELD_OUT, DELETED)}
    documents = {k: totals[k]["documents"] if k in totals else 0 for k in tokens}
    ranges = max(1, -(-sum(tokens.values()) // RANGE_KEYS))
    answers = stage(
        blocks.select("block", "kind", "lengths", "vocabulary", "counts", "stream")
        .mapInPandas(_requests(order, ranges), "block long, kind int, k int, slot int, keys binary, n binary")
        .groupBy("k", "slot").applyInPandas(_answer, _ANSWER), "answers",
    )
    distinct = answers.where("k = 1").agg(F.sum("distinct")).first()[0] or 0

    def at_blocks(function, schema, own: DataFrame, replies: DataFrame) -> DataFrame:
        return own.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(function, schema)

    steps = 4 if order == 2 else 1
    function, schema = _cells(order, documents[REST], tokens[REST], steps)
    cells = at_blocks(
        function, schema, blocks.where(f"kind = {DELETED}"), answers.where("deleted is not null")
    ).groupBy("bucket", *[f"q{k}" for k in range(1, order + 1)]).agg(
        F.sum("n").alias("n"), *[F.sum(f"f{k}").alias(f"f{k}") for k in range(1, order + 1)]
    ).toArrow()
    n = cells["n"].to_numpy().astype(float)
    f = np.array([
        np.full(len(n), 1 / (distinct + 1)),
        *(cells[f"f{k}"].to_numpy() / np.maximum(n, 1) for k in range(1, order + 1)),
    ])
    weights = learn_weights(n, cells["bucket"].to_numpy().astype(np.int64), f)
    learned = tokens[REST] + tokens[DELETED]
    function, schema = _scores(
        order, weights, documents[REST] + documents[DELETED], learned, distinct, id_type
    )
    scored = at_blocks(function, schema, blocks, answers.select("block", "k", "slot", "total"))
    return scored.select(
        F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known",
        F.lit(learned).cast("long").alias("train_tokens"), "base_score", "score",
    )
