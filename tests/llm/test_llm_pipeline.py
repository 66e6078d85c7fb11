"""Packing, and the pipeline's stages, against plain versions."""

import itertools
import os
import random
import sys
import zlib

import brute
import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from depotstar.llm import packing, toxicity  # noqa: E402
from depotstar.llm.common import table  # noqa: E402
from depotstar.llm.queries import ORACLE, QUERIES  # noqa: E402

PUBLIC = pytest.importorskip("public_tokenizers")
FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def tokenizer():
    return packing.Tokenizer.at(PUBLIC.path("byte_bpe_50k.json"))


def ids_of(tokenizer, text):
    return [*tokenizer.whole.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids(tokenizer):
    rng = random.Random(1)
    letters = "aAé漢\U0001f600 \t\n\x0b\r\x1c\x85\xa0.,'1<|endoftext|>"
    given = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)] + [
        "a  b\n c", "x \n y<|endoftext|>z ", "  lead", "tail  ", "don't I'll we've'", "", " ", "a b", " a",
        "a b  c", "x " * 500,
    ]
    for text in given:
        assert tokenizer.ids(text) == np.array(ids_of(tokenizer, text)[:-1], "<u4").tobytes(), repr(text)


def test_cut():
    assert packing.cut(5, 10) == [(0, 5)] and packing.cut(10, 10) == [(0, 10)]
    assert packing.cut(23, 10) == [(0, 3), (3, 10), (13, 10)]
    assert packing.cut(20, 10) == [(0, 10), (10, 10)] and packing.cut(1, 10) == [(0, 1)]


def least_bins(lengths, capacity):
    """The optimum by trying all packings, largest pieces first."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for room in sorted(set(rooms)):
            if room >= lengths[i]:
                at = rooms.index(room)
                place(i + 1, rooms[:at] + [room - lengths[i]] + rooms[at + 1:])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best[0]


def test_bound_and_best_fit():
    rng = random.Random(2)
    certified = 0
    for _ in range(150):
        capacity = rng.choice([10, 20, 37])
        lengths = np.array([rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 9))])
        bins, offsets = packing.best_fit(lengths, capacity)
        for b in range(bins.max() + 1):
            own = sorted(zip(offsets[bins == b], lengths[bins == b]))
            assert [o for o, _ in own] == [sum(x for _, x in own[:i]) for i in range(len(own))]
            assert sum(x for _, x in own) <= capacity
        optimum = least_bins(lengths.tolist(), capacity)
        assert packing.lower_bound(lengths, capacity) <= optimum <= bins.max() + 1
        certified += packing.lower_bound(lengths, capacity) == bins.max() + 1
    assert certified > 100
    # Beyond the sum of the lengths: three pieces above half need three bins.
    assert packing.lower_bound(np.array([6, 6, 6]), 10) == 3
    assert packing.lower_bound(np.array([4, 4, 4, 4, 4]), 10) == 3


def check_packing(rows, texts, tokenizer, capacity):
    rows = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    for _, own in itertools.groupby(rows, lambda r: r.sequence_id):
        at = 0
        for r in own:
            assert r.offset == at
            at += r.length
        assert at <= capacity
    got, expected = [], []
    for r in rows:
        got.append((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32))
    for i, text in texts:
        ids = ids_of(tokenizer, text)
        for p, (s, n) in enumerate(packing.cut(len(ids), capacity)):
            expected.append((str(i), p, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())))
    assert sorted(got) == sorted(expected)


@pytest.mark.parametrize("per_partition", [100_000, 20])
def test_pack(spark, tokenizer, per_partition):
    rng = random.Random(3)
    texts = [(i, " ".join(rng.choice("some words of many kinds") for _ in range(rng.randrange(300)))) for i in range(80)]
    texts += [(90, None), (91, ""), (92, "word " * 2000), (3, texts[3][1]), (None, "x"), (None, None)]
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in texts], "doc_id long, text string, uid int, part string")
    rows = packing.pack(df, PUBLIC.path("byte_bpe_50k.json"), 256, per_partition=per_partition).collect()
    check_packing(rows, texts, tokenizer, 256)
    bound = packing.lower_bound(np.array([r.length for r in rows]), 256)
    assert len({r.sequence_id for r in rows}) <= bound * 1.05 + 2
    assert packing.pack(df.limit(0), PUBLIC.path("byte_bpe_50k.json"), 256).collect() == []


def planted(spark, folder):
    """Tables with known toxic, repeated and contaminated documents among clean ones."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(rng.randrange(2, 9)))
    some = lambda n: " ".join(word() for _ in range(n))
    docs, labels, items = {}, [], [(i, some(30)) for i in range(5)]
    for i in range(300):
        docs[i] = some(60)
        if i % 3 == 0:
            docs[i] += " idiot scum " + some(5)
        labels.append((i, 1, int(i % 3 == 0)))
    for i in range(400, 410):
        docs[i] = docs[1 + 3 * (i - 400)]  # copies of clean documents
    for i in range(500, 505):
        docs[i] = f"{some(300)} {items[i - 500][1]} {some(50)}"
    docs[600] = f"{some(20)} me@mail.example.com {some(20)}"
    docs[601], docs[602] = None, ""
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


def test_stages(spark, tmp_path, tokenizer):
    folder = str(tmp_path)
    texts = planted(spark, folder)
    docs = table(spark, folder, "documents")
    kept = []
    for k, (_, function) in enumerate(corpus_pipeline.STAGES[:-1]):
        columns = docs.dtypes
        function(spark, docs, folder).write.parquet(f"{folder}/out{k}")
        docs = spark.read.parquet(f"{folder}/out{k}")
        assert docs.dtypes == columns
        kept.append({r.doc_id for r in docs.collect()})
    everything = set(texts)
    toxic = {i for i in range(0, 300, 3)}
    assert everything - kept[0] == toxic
    assert kept[0] - kept[1] == set(range(400, 410)) | {602}
    assert kept[1] - kept[2] == set(range(500, 505))
    assert kept[3] == kept[2]
    final = {r.doc_id: r for r in docs.collect()}
    assert "[EMAIL]" in final[600].text and final[600].n_chars == len(final[600].text)
    assert all(final[i].text == texts[i] and final[i].lang == "en" for i in final if i != 600)
    rows = corpus_pipeline.run(spark, folder).collect()
    check_packing(rows, [(i, r.text) for i, r in final.items()], tokenizer, 2048)


def test_stages_decide_by_row(spark, tmp_path):
    rng = random.Random(8)
    some = lambda n: " ".join("".join(rng.choice("abcdefghijklm") for _ in range(5)) for _ in range(n))
    a, b, c, d, e = (some(60) for _ in range(5))
    item = some(30)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    left = lambda out: sorted(map(tuple, out.collect()), key=str)
    rows = [(5, a), (5, a), (7, a), (7, b), (None, c), (None, c), (None, d), (9, d), (None, e)]
    out = corpus_pipeline.drop_near_duplicates(spark, frame(rows), str(tmp_path))
    assert left(out) == sorted([(5, a), (7, b), (None, c), (9, d), (None, e)], key=str)
    holds = f"{a} {item} {b}"
    rows = [(1, holds), (1, c), (None, holds), (None, d), (2, e), (3, None)]
    out = corpus_pipeline.drop_contaminated(spark, frame(rows), str(tmp_path))
    assert left(out) == sorted([(1, c), (None, d), (2, e), (3, None)], key=str)


@needs_tables
def test_pipeline_against_plain_stages(spark, tokenizer):
    docs = table(spark, FOLDER, "documents")
    model = toxicity.fit(docs, table(spark, FOLDER, "labels"))
    texts = {r.doc_id: r.text for r in docs.collect() if model.score((r.text or "").encode()) < 0.7}
    fps = {i: brute.fingerprint(t, 3) for i, t in texts.items()}
    links = [(a, b) for a, b in itertools.combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 2]
    texts = {i: texts[i] for i, first in brute.components(fps, links).items() if i == first}
    items = [brute.shingles(r.text, 5) for r in table(spark, FOLDER, "benchmark").collect()]
    texts = {
        i: t for i, t in texts.items()
        if not any(len(own & item) >= 0.8 * len(item) for own in [brute.shingles(t, 5)] for item in items if item)
    }
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in rows} == set(texts)
    plain = [(i, t) for i, t in texts.items() if not brute.personal(t)]
    ids = {str(i) for i, _ in plain}
    assert len(plain) > 50
    lengths = {}
    for r in rows:
        lengths[str(r.doc_id)] = lengths.get(str(r.doc_id), 0) + r.length
    assert sum(lengths[i] != len(ids_of(tokenizer, t)) for i, t in zip(map(str, texts), texts.values()) if i in ids) <= 2


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(corpus_pipeline.__file__)), "tools"))
    from compare import compare, connect

    assert compare(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) == "ok"


@needs_tables
def test_one_query_for_each_operator(spark):
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    documents = table(spark, FOLDER, "documents").count()
    for name in ("op2_pii", "op3_lm_score", "op4_toxicity", "op6_simhash", "op7_token_counts", "op9_quality"):
        assert QUERIES[name](spark, FOLDER).count() == documents
