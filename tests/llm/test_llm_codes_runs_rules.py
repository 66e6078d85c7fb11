"""Periodic runs, vector codes and quality rules against plain versions."""

import hashlib
import itertools
import os
import random
import re
import zlib

import numpy as np
import pytest

import brute
from depotstar.llm import codes, periodic, queries, rules

FOLDER = "/root/testdata/sf0.001"
given_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


# Periodic runs


def plain_runs(words, least):
    """Every stretch of every period, and the smallest period of each."""
    smallest = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i >= q:
                smallest.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in smallest.items() if n >= least), key=lambda r: (r[0], r[2]))


def found_runs(words, least):
    return [tuple(map(int, r)) for r in periodic.Factors(np.array(words, np.int64)).runs(least)]


def test_runs_of_all_binary_sequences():
    for n in range(1, 13):
        for words in itertools.product([0, 1], repeat=n):
            assert found_runs(words, 2) == plain_runs(words, 2), words


def test_runs_of_periodic_sequences():
    r = random.Random(3)
    for _ in range(600):
        words = []
        while len(words) < 90:
            words += [r.randrange(2) for _ in range(r.randrange(1, 8))] * r.randrange(1, 7)
        # Two alternating stretches that meet out of step have a run of every odd period between.
        words += [0, 1] * r.randrange(1, 12) + [1, 0] * r.randrange(1, 12)
        at = r.randrange(len(words))
        words = words[at:] + words[:at]
        assert found_runs(words, 2) == plain_runs(words, 2), words


def test_runs_of_fibonacci_words():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    assert found_runs(b, 2) == plain_runs(b, 2)


def test_long_text_of_one_word():
    assert found_runs([0] * 300_000, 12) == [(0, 300_000, 1)]


def test_blocks_keep_texts_apart():
    block = [[b"x"] * 7, [b"x"] * 7, [], [b"a", b"b"] * 9]
    runs, own = periodic.block_runs(block, 2)
    assert runs.tolist() == [[0, 7, 1], [0, 7, 1], [0, 18, 2]] and own.tolist() == [0, 1, 3]


def test_runs_of_rows(spark, rows):
    text = "one " + "Tick tock " * 8 + "tick"
    given = spark.createDataFrame(
        [(1, text, 0, 0), (1, text, 0, 0), (None, text, 0, 0), (2, None, 0, 0), (3, "", 0, 0), (4, " \n", 0, 0),
         (5, "a b " * 5 + "a", 0, 0)],
        "doc_id long, text string, runs int, id int",
    )
    found = periodic.periodic_runs(given)
    assert found.columns == ["doc_id", "runs", "collapsed"]
    got = {(r.doc_id, tuple(tuple(x) for x in r.runs), r.collapsed) for r in found.collect()}
    one = ((1, 16, 2),)
    assert found.count() == 7
    assert got == {
        (1, one, "one Tick tock tick"), (None, one, "one Tick tock tick"), (2, (), ""), (3, (), ""),
        (4, (), ""), (5, (), "a b a b a b a b a b a"),
    }
    assert periodic.periodic_runs(given.limit(0)).count() == 0


def digests(doc_id, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = plain_runs(words, 12)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    top = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, brute.sha(listed), brute.sha(kept),
    )


@given_tables
def test_op11_equals_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    got = {tuple(r) for r in queries.op11_periodic_runs(spark, FOLDER).collect()}
    assert got == {digests(r.doc_id, r.text) for r in docs}
    assert sum(r[1] > 0 for r in got) > len(docs) // 10


def test_planted_runs(spark, tmp_path):
    texts = [(i, " ".join(f"w{j}" for j in range(i % 90)) if i % 7 else None) for i in range(400)]
    texts += [(None, "a b c d e f g h i j k l m n"), (10, " \t "), (10, "again and again")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(str, (tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect())))
    assert got == sorted(str(digests(*t)) for t in texts)


# Vector codes


def plain_codes(given, parts=8, entries=16, rounds=6, scale=4096):
    ok = [r for r in given if r[1] and all(x is not None and np.isfinite(x) for x in r[1])]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.floor(np.array([r[1] for r in ok]) * scale).astype(np.int64).reshape(len(ok), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def nearest():
        return np.stack(
            [((x[:, p, None] - books[p][None]) ** 2).sum(2).argmin(1) for p in range(parts)], axis=1
        )

    for _ in range(rounds):
        own = nearest()
        for p, e in itertools.product(range(parts), range(books.shape[1])):
            mine = x[own[:, p] == e, p]
            if len(mine):
                books[p, e] = mine.sum(0) // len(mine)
    own = nearest()
    error = sum(((x[:, p] - books[p][own[:, p]]) ** 2).sum(1) for p in range(parts))
    rows = [(r[0], r[2], bytes(o.astype(np.uint8)).hex(), int(e)) for r, o, e in zip(ok, own, error)]
    return sorted(rows, key=str), books


LAYOUT = "vec_id long, embedding array<double>, label int, code string, x int, id int, sums int"


def coded(spark, given):
    df = spark.createDataFrame([(*r, "?", 1, 2, 3) for r in given], LAYOUT).repartition(3)
    found, books = codes.encode(df)
    return sorted((tuple(r) for r in found.collect()), key=str), books, found


def test_codes_with_ties_and_unusable_vectors(spark):
    r = random.Random(5)
    given = [
        # Components on a coarse grid: many equal distances, and means that are no integers.
        (i, [r.randrange(-3, 4) / 2048 for _ in range(16)], r.choice([None, 1, 2])) for i in range(300)
    ]
    given += given[:40] + [(None, given[3][1], None), (7, [0.25] * 16, 4)]
    given += [(900, None, 1), (901, [], 1), (902, [None] * 16, 1), (903, [float("nan")] + [0.0] * 15, 2),
              (904, [float("-inf")] + [0.0] * 15, None)]
    got, books, found = coded(spark, given)
    expected, entries = plain_codes(given)
    assert got == expected and (books == entries).all()
    whole = codes.with_label_errors(found).collect()
    sums = {}
    for _, label, _, error in expected:
        sums[label] = sums.get(label, 0) + error
    assert len(whole) == len(expected) and all(r.label_error == sums[r.label] for r in whole)


@pytest.mark.parametrize("n", [1, 2, 5, 17])
def test_codes_of_few_vectors(spark, n):
    r = random.Random(n)
    given = [(i, [r.gauss(0, 1) for _ in range(8)], 0) for i in range(n)]
    got, books, _ = coded(spark, given)
    expected, entries = plain_codes(given)
    assert got == expected and (books == entries).all()


def test_codes_of_nothing(spark):
    for given in ([], [(1, None, 1), (2, [], None)]):
        got, books, found = coded(spark, given)
        assert got == [] and books.size == 0 and codes.with_label_errors(found).count() == 0


def test_codes_refuse_what_they_cannot_code(spark):
    with pytest.raises(ValueError):
        coded(spark, [(1, [1.0] * 8, 0), (2, [1.0] * 16, 0)])
    with pytest.raises(ValueError):
        coded(spark, [(1, [1.0] * 9, 0)])


def test_bounds_hold_and_save_distances():
    """Rounds on moving entries: every bound holds, entries are exact, and most need no list."""
    r = np.random.default_rng(2)
    centres = r.integers(-4000, 4000, (16, 8))
    x = centres[r.integers(0, 16, 4000)] + r.integers(-900, 900, (4000, 8))
    entries = x[:16].copy()
    b, settled = 4, []
    state = codes.Bounds.unknown(len(x), b)
    for _ in range(8):
        depth = state.assign(x, entries)
        settled.append((depth == 0).mean())
        square = ((x[:, None] - entries[None]) ** 2).sum(2)
        assert (state.entry == square.argmin(1)).all()
        distance, rows = np.sqrt(square), np.arange(len(x))
        low = codes._ordered(state.low)
        assert (distance[rows, state.entry] <= state.upper).all()
        listed = np.zeros(square.shape, bool)
        listed[rows, state.entry] = True
        for j in range(b):
            assert (low[:, j] <= distance[rows, state.near[:, j]]).all()
            listed[rows, state.near[:, j]] = True
        assert (low[:, -1:] <= np.where(listed, np.inf, distance)).all()
        b = min(b, max([2, *depth[depth <= b].tolist()]))
        new = np.array([x[state.entry == e].sum(0) // max((state.entry == e).sum(), 1) for e in range(16)])
        by = np.sqrt(((new - entries) ** 2).sum(1)) * (1 + 1e-9)
        entries, state = new, state.shrunk(b).moved(by)
    assert settled[0] == 0 and settled[-1] > 0.5


# Quality rules


def plain_rules(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = list(zip(words, words[1:], words[2:]))
    counts = {w: windows.count(w) for w in set(windows)}
    again = {j for i, w in enumerate(windows) if counts[w] > 1 for j in (i, i + 1, i + 2)}
    n = len(words)
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again),
        n < 50 or 100 * len(again) > 50 * n,
    )


def texts_for_rules():
    r = random.Random(9)
    some = ["the", "and", "öl", "x|y", "#1", "a", "b", "fin.", "…", "9"]
    made = [
        "".join(r.choice(some) + r.choice([" ", " ", "\n", "\t\r\n ", "\x0b\x0c"]) for _ in range(r.randrange(160)))
        for _ in range(150)
    ]
    return made + [None, "", " \n\t", "a a a", "a a a a", "fff f f", "x" * 5000, "the of and " * 4000]


def test_rules_counts(spark):
    texts = texts_for_rules()
    given = spark.createDataFrame(
        [(i if i % 9 else None, t, "?", 1) for i, t in enumerate(texts)] * 2,
        "doc_id long, text string, failed string, n_words int",
    )
    found = rules.judge(given)
    got = found.select(
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    ).collect()
    assert sorted(map(tuple, got)) == sorted([plain_rules(t) for t in texts] * 2)
    assert all(r.kept == (not r.failed) for r in found.collect())
    assert rules.judge(given.limit(0)).count() == 0


def test_each_rule_alone(spark):
    """A clean text passes; one defect at a time names its rule."""
    r = random.Random(4)
    clean = [r.choice(["the", "and", "river", "stone", "walks", "of", "green"]) + str(i) * (i % 3 == 0) for i in range(80)]
    clean = ["the", "and", "of", "in", "to"] * 2 + clean

    def with_lines(start="", end="", n=10):
        return "\n".join(f"{start}{' '.join(clean[i * 9:i * 9 + 9])}{end}" for i in range(n))

    texts = {
        "": with_lines(), "few_words": "the of and in to it is", "repeats_itself": "the same old words " * 20,
        "short_words": "a " * 30 + " ".join(f"{chr(97 + i % 26)}" for i in range(60)),
        "long_words": " ".join(f"the {'abcde' * 9}{i}" for i in range(60)),
        "symbols": with_lines("# | ", " |"), "exclaims": " ".join(w + "!" for w in clean),
        "few_letters": with_lines() + " " + " ".join(str(i) for i in range(60)),
        "no_stop_words": " ".join(f"word{i}" for i in range(60)),
        "repeated_lines": with_lines() + "\nthe end" * 12, "bullets": with_lines("- "), "cut_lines": with_lines("", "..."),
    }
    given = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    for row in rules.judge(given).collect():
        assert (row.doc_id in row.failed) if row.doc_id else row.kept, row
    open_table = rules.judge(given, rules=(), base=())
    assert open_table.where("kept").count() == len(texts)


def test_rules_run_without_python(spark):
    found = rules.judge(spark.range(9).selectExpr("id as doc_id", "string(id) as text"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|InArrow|Pandas|Exchange|Join", plan)


def test_digest_of_codebooks():
    books = np.arange(-4, 4).reshape(2, 2, 2)
    assert codes.digest(books) == hashlib.sha256(b"-4,-3,-2,-1,0,1,2,3").hexdigest()
