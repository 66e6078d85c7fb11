"""Components, embedding and SimHash near-duplicates against brute force."""

import itertools
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from depotstar.llm import components, embeddings, simhash


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    links += [(i, i + 1) for i in range(100, 140)]  # a long path
    links += [(200, i) for i in range(201, 230)] + [(5, 5), (None, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    real = [(a, b) for a, b in links if a is not None and a != b]
    nodes = {n for link in real for n in link}
    assert {r.node: r.component for r in components.components(df).collect()} == brute.components(nodes, real)
    assert components.components(df).count() == len(nodes)


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def vectors():
    rng = np.random.default_rng(3)
    rows = []
    for centre in rng.standard_normal((6, 24)):
        for _ in range(12):
            rows.append((centre + rng.normal(0, rng.choice([0.02, 0.1, 0.25]), 24)).tolist())
    rows += [rows[0], rows[0], [2 * x for x in rows[0]], [-x for x in rows[0]], [1e200 * x for x in rows[5]]]
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23,
           [1.0, 2.0], [2.0, 4.0], [0.0, -0.0, 1.0], [-0.0, 0.0, 2.0]]
    order = list(range(len(rows) + len(odd)))
    random.Random(1).shuffle(order)
    return [(100 + i, v, "x", 1) for i, v in zip(order, rows + odd)]


@pytest.mark.parametrize("block", [1000, 5])
def test_embeddings(spark, block):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, digest string, n int")
    good = {
        i: v for i, v, *_ in rows
        if v and None not in v and np.isfinite(v).all() and any(v)
    }
    links = [
        (a, b) for a, b in itertools.combinations(sorted(good), 2)
        if len(good[a]) == len(good[b])
        and brute.cosine(np.array(good[a]) / max(map(abs, good[a])), np.array(good[b]) / max(map(abs, good[b]))) >= 0.95
    ]
    expected = brute.components([r[0] for r in rows], links)
    found = {r.id: r for r in embeddings.near_duplicates(df, recall=0.99999999, block=block).collect()}
    assert {i: r.component_id for i, r in found.items()} == expected
    assert {i: r.n_links for i, r in found.items()} == {
        r[0]: sum(r[0] in link for link in links) for r in rows
    }
    assert max(r.n_links for r in found.values()) > 3


def test_embeddings_without_ids_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert embeddings.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    df = spark.createDataFrame([(None, [1.0, 0.0]), (None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0])], schema)
    rows = sorted(embeddings.near_duplicates(df).collect(), key=str)
    assert [(r.id, r.n_links, r.component_id) for r in rows] == [(1, 1, 1), (1, 1, 1), (None, 0, None), (None, 0, None)]


def test_recall_at_the_threshold():
    rng = np.random.default_rng(0)
    a = embeddings._unit(rng.standard_normal((3000, 64)))
    other = rng.standard_normal((3000, 64))
    other -= (other * a).sum(1, keepdims=True) * a
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * embeddings._unit(other)
    tables = embeddings.Tables.fitting(100_000, 0.95)
    assert (tables.codes(a) == tables.codes(embeddings._unit(b))).any(1).mean() > 0.98


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4])
def test_pigeonring_links(spark, distance):
    rng = random.Random(distance)
    fps = set()
    for _ in range(25):
        fp = rng.getrandbits(64)
        fps.add(fp)
        for _ in range(8):
            near = fp
            for bit in rng.sample(range(64), rng.randrange(1, 6)):
                near ^= 1 << bit
            fps.add(near)
    fps |= {0, 1, (1 << 64) - 1, 1 << 63}
    signed = {f - (f >> 63 << 64): f for f in fps}
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = {frozenset((r.a, r.b)) for r in simhash.links(df, distance).collect()}
    assert found == {
        frozenset((a, b)) for a, b in itertools.combinations(signed, 2)
        if (signed[a] ^ signed[b]).bit_count() <= distance
    }


def documents():
    rng = random.Random(4)
    vocabulary = ["Alpha", "beta", "gamma", "DELTA", "épsilon", "zeta", "É", "eta"] + [f"w{i}" for i in range(40)]
    rows = []
    for i in range(30):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 120))]
        rows.append(" ".join(own))
        changed = list(own)
        changed[rng.randrange(len(own))] = "changed"
        rows += ["\t".join(changed), "\n".join(w.upper() for w in own)]
    rows += [None, "", "  \n", "one", "one two", "One  two", "one two three", " x  y", "a" * 5000]
    return [(i, t, "fp", 0) for i, t in enumerate(rows)] + [(2, rows[2], "fp", 0), (None, rows[0], "fp", 0)]


def test_simhash(spark):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, first int")
    fps = [brute.fingerprint(t, 3) for _, t, *_ in rows]
    links = [(a, b) for a, b in itertools.combinations(set(fps), 2) if (a ^ b).bit_count() <= 2]
    group = brute.components(set(fps), links)
    least = {}
    for (i, *_), fp in zip(rows, fps):
        if i is not None:
            least[group[fp]] = min(i, least.get(group[fp], i))
    expected = sorted((str(i), f"{fp:016x}", least[group[fp]]) for (i, *_), fp in zip(rows, fps))
    got = simhash.near_duplicates(df).withColumn("hex", simhash.hexadecimal()).collect()
    assert sorted((str(r.id), r.hex, r.component_id) for r in got) == expected
    assert len(links) > 0


def test_simhash_of_nothing(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([(None, None), (None, "")], "doc_id long, text string")
    assert [(r.id, r.fp, r.component_id) for r in simhash.near_duplicates(df).collect()] == [(None, 0, None)] * 2


def test_shingle_hash_is_that_of_spark(spark):
    text = "drei Wörter hier"
    spark_hash = spark.range(1).select(F.xxhash64(F.lit(text.lower()))).first()[0]
    assert simhash.fingerprint(text.encode(), 3) == spark_hash
