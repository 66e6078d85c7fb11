"""Words, decontamination, personal data, chunks and token counts against brute force."""

import random
import re

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotstar.llm import chunks, decontaminate, pii, token_counts, tokens

PUBLIC = pytest.importorskip("public_tokenizers")


def texts():
    rng = random.Random(2)
    letters = "aAbBzZéÉ漢\U0001f600 \t\n\x0b\x0c\r\x1c .,"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(60)] + [
        "", " ", "x", " x", "x ", "a" * 3000 + " " + "b" * 3000, "end",
    ]


@pytest.mark.parametrize("chunk", [1 << 19, 50])
def test_words(monkeypatch, chunk):
    monkeypatch.setattr(tokens, "_CHUNK", chunk)
    given = texts()
    found = tokens.words(pa.array(["skipped", *given]).slice(1))
    expected = [brute.words(t) for t in given]
    assert np.diff(found.first).tolist() == [len(w) for w in expected]
    flat = [w for own in expected for w in own]
    assert [found.text(i, i + 1) for i in range(len(flat))] == flat
    by_word = dict(zip(flat, found.hash.tolist()))
    assert [by_word[w] for w in flat] == found.hash.tolist() and len(set(by_word.values())) == len(by_word)


def test_no_words():
    assert tokens.words(pa.array([], pa.string())).first.tolist() == [0]
    assert tokens.words(pa.array(["", ""])).first.tolist() == [0, 0, 0]


def benchmark_rows():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (3, 5, 6, 8, 14, 25, 40, 60)]
    docs = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 400))) for _ in range(30)]
    for i, item in enumerate(items):
        own = item.split()
        broken = list(own)
        broken[len(own) // 2] = "changed"
        half = len(own) // 2 + 2
        docs += [
            f"{docs[i]} {item.upper()} {docs[i + 1]}", " ".join(broken), docs[i] + " " + " ".join(broken) + " x",
            " ".join(own[:half]) + f" {docs[i]} " + " ".join(own[-half:]), "\n".join(own),
        ]
    docs += [None, "", "w1", "w1 W2"]
    items += [None, "", "w1 w2", items[3]]
    return (
        [(i, t, "a", 1) for i, t in enumerate(docs)] + [(0, items[4], "a", 1), (None, items[4], "a", 1)],
        [(100 + i, t, "b", 2) for i, t in enumerate(items)] + [(None, items[4], "b", 2), (104, items[4], "b", 2)],
    )


@pytest.mark.parametrize("n", [5, 3])
def test_contained(spark, n):
    docs, items = benchmark_rows()
    def sets(rows):
        out = {}
        for i, t, *_ in rows:
            if i is not None:
                out.setdefault(i, set()).update(brute.shingles(t, n))
        return out
    held = {
        (d, i, len(a & b), len(b)) for d, a in sets(docs).items() for i, b in sets(items).items()
        if b and len(a & b) >= 0.8 * len(b)
    }
    found = decontaminate.contained(
        spark.createDataFrame(docs, "doc_id long, text string, shingle string, size int"),
        spark.createDataFrame(items, "item_id long, text string, item string, at int"), shingle=n,
    )
    assert {tuple(r)[:4] for r in found.collect()} == held and found.count() == len(held) > 15


def test_short_items_in_very_long_documents(spark, monkeypatch):
    rng = random.Random(31)
    items = [" ".join(f"i{n}w{k}" for k in range(rng.choice([3, 5, 6, 14, 40]))) for n in range(40)]
    held, docs = set(), []
    for d in range(12):
        words = [f"w{rng.randrange(50_000)}" for _ in range(30_000)]
        for n in rng.sample(range(40), 6):
            at = rng.randrange(len(words))
            words[at:at] = items[n].split()
            held.add((d, n))
        docs.append((d, " ".join(words)))
    docs.append((99, " ".join(items[0].split()[:3])))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    # A text of fewer than five words is a shingle of its own, which no longer text has.
    expected = {(a, b) for a, b in held if len(items[b].split()) >= 5}
    if len(items[0].split()) == 3:
        expected.add((99, 0))

    def pairs():
        return {(r.doc, r.item) for r in decontaminate.contained(d, i).collect()}

    assert pairs() == expected
    # Spread like frequent ones, the shingles give the same pairs.
    monkeypatch.setattr(
        decontaminate, "hot_keys", lambda df, keys: [tuple(r) for r in df.select(*keys).distinct().limit(200).collect()]
    )
    assert pairs() == expected


def test_contained_at_other_thresholds(spark):
    docs, items = benchmark_rows()
    d = spark.createDataFrame([r[:2] for r in docs if r[0] is not None], "doc_id long, text string").dropDuplicates(["doc_id"])
    i = spark.createDataFrame([r[:2] for r in items if r[0] is not None], "item_id long, text string").dropDuplicates(["item_id"])
    of = {r.doc_id: brute.shingles(r.text, 3) for r in d.collect()}
    want = {r.item_id: brute.shingles(r.text, 3) for r in i.collect()}
    for threshold in (0.1, 0.5, 1.0):
        expected = {
            (a, b) for a, x in of.items() for b, y in want.items() if y and len(x & y) >= threshold * len(y) and x & y
        }
        got = decontaminate.contained(d, i, shingle=3, threshold=threshold).collect()
        assert {(r.doc, r.item) for r in got} == expected


def test_clean(spark):
    docs, items = benchmark_rows()
    docs = spark.createDataFrame(docs, "doc_id long, text string, item string, size int")
    items = spark.createDataFrame(items, "item_id long, text string, item string, size int")
    bad = {r.doc for r in decontaminate.contained(docs, items).collect()}
    left = decontaminate.clean(docs, items)
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == sorted(
        str(r.doc_id) for r in docs.collect() if r.doc_id not in bad
    )
    none = items.limit(0)
    assert decontaminate.clean(docs, none).count() == docs.count()
    assert decontaminate.contained(docs.limit(0), items).collect() == []


EDGES = [
    "a@b.c.d%x@d.e a@b@c.d x@y @a.b .@.c a@-.b",
    "1.2.3.4.5.6.7.8 999.1.1.1 001.02.3.255 1.2.3 0000.0.0.0 256.1.1.1 0256.1.1.1 0.0.0.0 1.1.1.09",
    "+1 (017) 555-7713 ... é +1 23 45 67 89 01- x 4111 1111-1111 1111, 4111111111111111. 4111111111111112",
    "漢字 a@b.co\U0001f600 +1 2345678901", None, "", "\n", "nothing here",
    "a" * 20000 + " " + "1" * 20000 + " a@" + ".b" * 3000 + " a@b" + ".c" * 3000 + " +" + "1 " * 9000,
    "+1234567890+1234567890 12.34.56.78.90@x.y-z 4111-1111-1111-1111@x.y", "00.00.00.00.1 1.1.1.1111",
]


def test_personal_data(spark):
    rng = random.Random(5)
    rows = EDGES + ["".join(rng.choice("01245 .-+@a(") for _ in range(120)) for _ in range(150)]
    rows = [(i, t, "base", 3) for i, t in enumerate(rows)] + [(0, EDGES[0], "base", 3), (None, EDGES[0], "base", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, base string, uid int")
    got = sorted(pii.digests(pii.find(df)).collect(), key=lambda r: str(r.doc_id))
    assert len(got) == len(rows)
    for r, (_, text, *_) in zip(got, sorted(rows, key=lambda r: str(r[0]))):
        base = brute.personal(text)
        assert r.base_sha256 == brute.sha(brute.spans_text(base)), text[:100]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for *_, k in base) for kind in brute.FORMS]
        assert set(brute.spans_text(base).split(",")) <= set(r.spans.split(","))


def test_contexts_find_more(spark):
    rng = random.Random(6)
    rows = [
        f"please write to user{i}@mail{i}.example.com about item {rng.randrange(1000)} then wait" for i in range(20)
    ] + [
        "please write to user(at)99 about nothing", "we sold user77 and 12 others", "unrelated 5 words",
    ]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(df).collect()}
    assert [(rows[20][s.start:s.end], s.kind) for s in found[20].added] == [("user(at)99", "email")]
    assert not any(found[i].added for i in found if i != 20)
    redacted = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert redacted[20] == "please write to [EMAIL] about nothing" and redacted[21] == rows[21]
    assert all("@" not in redacted[i] and "please write to [EMAIL] about item" in redacted[i] for i in range(20))


def luhn(digits):
    total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits + "0"))) % 10
    return digits + str(-total % 10)


def test_contexts_of_phones_and_cards(spark):
    rng = random.Random(7)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    cards = [luhn("4" + digits(14)) for _ in range(12)]
    rows = [f"you may reach us at +1 ({digits(3)}) 555-{digits(4)}, or come by on day {i}" for i in range(12)]
    rows += [f"she paid by card {c[:4]} {c[4:8]} {c[8:12]} {c[12:]} on Monday" for c in cards]
    broken = cards[0][:-1] + str((int(cards[0][-1]) + 1) % 10)
    hidden = {
        24: ("743 555 3824", "phone"), 25: ("(743) 555-3824", "phone"), 26: ("743.555.3824", "phone"),
        27: (f"{broken[:4]} {broken[4:8]} {broken[8:12]} {broken[12:]}", "card"),
    }
    rows += [f"you may reach us at {hidden[i][0]}, or come by on day 3" for i in (24, 25, 26)]
    rows += [f"she paid by card {hidden[27][0]} on Monday", "we sold 743 555 items on 12 days"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(df).collect()}
    assert {i: [(rows[i][s.start:s.end], s.kind) for s in r.added] for i, r in found.items() if r.added} == {
        i: [x] for i, x in hidden.items()
    }
    redacted = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert redacted[27] == "she paid by card [CARD] on Monday" and redacted[28] == rows[28]
    assert all(redacted[i].startswith("you may reach us at [PHONE], or come") for i in [*range(12), 24, 25, 26])


def plain_patterns(edges, turns, least, support):
    """The scores of all patterns, turn by turn, from a list of (pattern, token, seed)."""
    of = {}
    for pattern, token, seed in edges:
        of.setdefault(pattern, {}).setdefault(token, None)
        of[pattern][token] = max(filter(None, (of[pattern][token], seed)), default=None)
    seeds = {(t, k) for tokens in of.values() for t, k in tokens.items() if k}
    scores, known = dict.fromkeys(seeds, 1.0), set(seeds)
    # A seed supports the patterns in which it is one; a discovered token all that it is met in.
    counts = {}
    for pattern, tokens in of.items():
        for k in tokens.values():
            if k:
                counts[pattern, k] = counts.get((pattern, k), 0) + 1
    for turn in range(turns):
        patterns = {}
        for (pattern, k), n in counts.items():
            if n >= support:
                found = [scores[t, k] for t in of[pattern] if (t, k) in scores]
                if found:
                    patterns[pattern, k] = sum(found) / (len(of[pattern]) + 1)
        if turn + 1 == turns:
            break
        missed = {}
        for (pattern, k), score in patterns.items():
            for t in of[pattern]:
                missed[t, k] = missed.get((t, k), 1) * (1 - score)
        scores = {**{x: 1 - m for x, m in missed.items()}, **dict.fromkeys(seeds, 1.0)}
        for t, k in [x for x, score in scores.items() if score >= least and x not in known]:
            known.add((t, k))
            for pattern, tokens in of.items():
                if t in tokens:
                    counts[pattern, k] = counts.get((pattern, k), 0) + 1
    best = {}
    for (pattern, k), score in patterns.items():
        if score >= least:
            best[pattern] = max(best.get(pattern, (0, "")), (score, k))
    return {p: (k, round(score, 9)) for p, (score, k) in best.items()}


@pytest.mark.parametrize("turns", [1, 2, 3, 4])
def test_pattern_scores_against_plain_turns(spark, turns):
    rng = random.Random(turns)
    edges = []
    for p in range(40):
        kind = rng.choice(["email", "phone", "card"])
        for t in rng.sample(range(60), rng.randrange(1, 14)):
            token = f"t{t}"
            seed = kind if t % 3 == 0 and rng.random() < 0.9 else None
            edges += [(f"p{p}", token, seed)] * rng.choice([1, 1, 3])
        if p % 4 == 0:
            edges += [(f"p{p}", f"s{p}-{i}", kind) for i in range(rng.randrange(2, 9))]
    df = spark.createDataFrame(edges, "pattern string, token string, seed string")
    for least, support in ((0.8, 3), (0.5, 2), (0.5, 4)):
        got = {r.pattern: (r.kind, round(r.score, 9)) for r in pii.score_patterns(df, turns, least, support).collect()}
        assert got == plain_patterns(edges, turns, least, support)


def test_what_one_pattern_discovers_supports_the_next(spark):
    hidden = [f"user{i}(at)host" for i in range(12)]
    rows = [f"please write to u{i}@mail{i}.example.com about thing" for i in range(60)]
    rows += [f"please write to {h} about thing" for h in hidden]
    # A second context knows none of the seeds, only what the first one discovers, and one more.
    rows += [f"complaints reach agent {h} within hours" for h in hidden]
    rows += ["complaints reach agent unseen(at)77 within hours", "nothing about 12 here"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    added = {r.doc_id: [(rows[r.doc_id][s.start:s.end], s.kind) for s in r.added] for r in pii.find(df).collect()}
    assert added[len(rows) - 2] == [("unseen(at)77", "email")] and added[len(rows) - 1] == []
    assert all(added[i] == [(h, "email")] for i, h in enumerate(hidden, 60))
    once = {r.doc_id: r.added for r in pii.find(df, turns=1).collect()}
    assert once[len(rows) - 2] == [] and len(once[60]) == 1


def test_contexts_are_whole_words(spark):
    long = "x" * 5000
    rows = [f"{long} {long}y u{i}@mail{i}.example.com {long}z" for i in range(6)] + [f"{long} {long}y hidden(at)9 {long}z"]
    rows += [f"{long} {long[:300]}y other(at)9 {long}z"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    added = {r.doc_id: len(r.added) for r in pii.find(df).collect()}
    assert added == {**dict.fromkeys(range(6), 0), 6: 1, 7: 0}


def test_redact(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(EDGES)] + [(None, "a@b.c", "y", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, n long")
    got = sorted(pii.redact(df).collect(), key=lambda r: str(r.doc_id))
    assert pii.redact(df).columns == df.columns
    for r, (i, text, spans, n) in zip(got, sorted(rows, key=lambda r: str(r[0]))):
        out, at = [], 0
        for a, b, kind in brute.personal(text):
            if a >= at:
                out += [text[at:a], f"[{kind.upper()}]"]
            at = max(at, b)
        assert (r.text, r.spans, r.n) == (text and "".join(out) + text[at:], spans, n)
    assert pii.digests(pii.find(df.limit(0))).collect() == []


def test_redact_carries_a_text_once(spark, monkeypatch):
    staged, real = {}, pii.stage
    monkeypatch.setattr(pii, "stage", lambda df, name: staged.setdefault(name, df) and real(df, name))
    rows = [(1, "write to a@b.cd", "x"), (2, None, "y"), (3, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(tuple(r) for r in pii.redact(df).select("doc_id", F.coalesce("text", F.lit("none")), "lang").collect())
    assert got == [(1, "write to [EMAIL]", "x"), (2, "none", "y"), (3, "", "z")]
    carried = staged["found"].schema
    assert carried["text"].dataType == T.StringType() and carried["row"].dataType["text"].dataType == T.BooleanType()


def test_cuts():
    rng = random.Random(9)
    text = "".join(rng.choice("abcdé漢 \n") for _ in range(20000)).encode()
    ends = chunks.cuts(text, 32, 5, 512)
    assert ends[-1] == len(text) and ends == sorted(set(ends))
    sizes = np.diff([0, *ends])
    assert sizes[:-1].min() >= 32 and sizes.max() <= 515 and 50 < sizes.mean() < 90
    for a, b in zip([0, *ends], ends):
        text[a:b].decode()
    # The plain rolling form of the hash.
    data = np.frombuffer(text, np.uint8)
    h, rolled = 0, []
    for b in data[:3000]:
        h = (h * 2 + int(chunks._GEAR[b])) % 2**16
        rolled.append(h)
    assert [int(x) & 0xFFFF for x in chunks.gear(data[:3000])] == rolled
    # An insertion moves only the cuts beside it.
    inserted = text[:5000] + b" inserted words " + text[5000:]
    pieces = {text[a:b] for a, b in zip([0, *ends], ends)}
    again = chunks.cuts(inserted, 32, 5, 512)
    new = [inserted[a:b] for a, b in zip([0, *again], again)]
    assert sum(p not in pieces for p in new) <= 6
    assert chunks.cuts(b"", 32, 5, 512) == [] and chunks.cuts(b"x" * 2000, 32, 5, 512)[-1] == 2000


def test_repeated_passages(spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("abcdefghijklmnopé") for _ in range(rng.randrange(2, 9)))
    some = lambda n: " ".join(word() for _ in range(n))
    passages = [some(60) for _ in range(20)]
    rows = [(i, some(200), "x", 1) for i in range(20)]
    for i, p in enumerate(passages):
        rows += [(100 + 10 * i + j, f"{some(rng.randrange(80))} {p} {some(30)}", "x", 1) for j in range(3)]
    rows += [(1000, None, "x", 1), (1001, "", "x", 1), (1002, "short", "x", 1), (1003, "short", "x", 1)]
    rows += [(None, rows[0][1], "x", 1), (1004, rows[0][1], "x", 1), (1004, rows[0][1], "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string, number int")
    found = chunks.repeated_spans(df).collect()
    text = {i: t for i, t, *_ in rows}
    for i, p in enumerate(passages):
        for j in range(3):
            own = [r for r in found if r.doc_id == 100 + 10 * i + j]
            assert own and all(text[r.doc_id][r.start + 3:r.end - 3] in p for r in own)
            assert sum(r.end - r.start for r in own) > 0.3 * len(p)
            # Chunks at the ends may be cut alike in two of the three copies only.
            most = max(own, key=lambda r: r.end - r.start)
            assert most.kept == (j == 0) and most.copies == 3 and {r.copies for r in own} <= {2, 3}
            assert all(r.passage_start <= r.start and r.end <= r.passage_end for r in own)
            assert all(100 + 10 * i <= r.first_doc_id <= r.doc_id for r in own)
    assert {r.doc_id for r in found if r.doc_id is None or r.doc_id < 100 or r.doc_id >= 1000} == {None, 0, 1004}
    assert chunks.repeated_spans(df.limit(0)).collect() == []
    # Every repeated chunk, against a dictionary.
    seen = {}
    for r in chunks.chunks(df).collect():
        seen.setdefault(text[r.id][r.start:r.start + r.length] if r.id is not None else rows[0][1][r.start:r.start + r.length], []).append(r)
    every = chunks.repeated(df).collect()
    assert len(every) == sum(len(v) for v in seen.values() if len(v) > 1)
    assert sum(r.is_first for r in every) == sum(len(v) > 1 for v in seen.values())
    whole = {}
    for r in chunks.chunks(df).where("id is not null and id <> 1004").orderBy("id", "number").collect():
        whole[r.id] = whole.get(r.id, "") + text[r.id][r.start:r.start + r.length]
    assert whole == {i: t for i, t in text.items() if t and i is not None and i != 1004}


def plain_passages(chunk_rows, text_of, least_chars):
    """Passages and their parts from a dictionary of all chunks; rows must have ids of their own."""
    of = {(r.id, r.number): text_of[r.id][r.start:r.start + r.length] for r in chunk_rows}
    places = {}
    for r in sorted(chunk_rows, key=lambda r: (r.id, r.start)):
        places.setdefault(of[r.id, r.number], []).append((r.id, r.start))
    out, own = [], {}
    for r in sorted(chunk_rows, key=lambda r: (r.id, r.number)):
        if len(places[of[r.id, r.number]]) > 1:
            own.setdefault(r.id, []).append(r)
    for doc, rows in own.items():
        runs = []
        for r in rows:
            if runs and runs[-1][-1].number + 1 == r.number:
                runs[-1].append(r)
            else:
                runs.append([r])
        for run in runs:
            begin, end = run[0].start, run[-1].start + run[-1].length
            if end - begin < least_chars:
                continue
            parts = []
            for r in run:
                first = places[of[r.id, r.number]][0]
                kept = first == (r.id, r.start)
                if not parts or parts[-1][3] != kept:
                    parts.append([doc, r.start, 0, kept, 0, first[0], begin, end])
                parts[-1][2] = r.start + r.length
                parts[-1][4] = max(parts[-1][4], len(places[of[r.id, r.number]]))
            out += map(tuple, parts)
    return sorted(out)


def test_passages_with_frequent_phrases_lose_nothing(spark):
    """Phrases that occur all over lie inside of longer passages, mostly not for the first time."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghijklmnopé") for _ in range(rng.randrange(2, 9)))
    some = lambda n: " ".join(word() for _ in range(n))
    phrases = [some(12) for _ in range(3)]
    passages = [f"{some(15)} {rng.choice(phrases)} {some(15)}" for _ in range(25)]
    texts = [f"{some(20)} {p} {some(20)}" for p in phrases * 3]
    for p in passages:
        texts += [f"{some(rng.randrange(40))} {p} {some(30)}" for _ in range(2)]
    texts += [some(50) + "\n" + texts[3], texts[5] * 2, None, ""]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = plain_passages(chunks.chunks(df).collect(), dict(rows), 72)
    got = sorted(tuple(r) for r in chunks.repeated_spans(df, 72).collect())
    assert got == expected
    # Many a passage is in parts, some of them shorter than the limit for the whole.
    assert sum(r[2] - r[1] < 72 for r in got) > 2
    assert chunks.repeated_spans(df, 10**6).collect() == []


def test_passages_of_a_very_long_text(spark):
    rng = random.Random(22)
    line = "".join(rng.choice("abcdefgh ") for _ in range(300))
    long = (line + " ") * 1500
    df = spark.createDataFrame([(1, long), (2, line)], "doc_id long, text string")
    found = chunks.repeated_spans(df).collect()
    covered = sum(r.end - r.start for r in found if r.doc_id == 1)
    assert covered > 0.98 * len(long) and sum(r.end - r.start for r in found if r.kept) < 1000


def unigram(path):
    import sentencepiece
    import tokenizers

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]
    own = tokenizers.Tokenizer(tokenizers.models.Unigram(scores, unk_id=0, byte_fallback=True))
    return lambda t: len(own.encode("▁" + t.replace(" ", "▁"), add_special_tokens=False).ids) if t else 0


def test_token_counts(spark):
    path = PUBLIC.path("piece_bpe_32k.model")
    expected = unigram(path)
    rng = random.Random(12)
    given = texts() + [
        "hello world  this is   ", "漢字 \U0001f600x", "a▁b  c", "   y", "a  \n  b", "\n\n", "x " * 3000,
        "".join(rng.choice("thea onig") for _ in range(3000)),
    ]
    rows = [(i, t, 1, "x") for i, t in enumerate(given)] + [(None, None, 1, "x"), (0, given[0], 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, n_chars string")
    got = sorted((tuple(r) for r in token_counts.token_counts(df, path).collect()), key=str)
    assert got == sorted(((i, expected(t or ""), len(t or "")) for i, t, *_ in rows), key=str)
    assert token_counts.token_counts(df.limit(0), path).collect() == []


def test_token_count_ties_and_unknowns():
    import tokenizers

    rng = random.Random(13)
    for _ in range(60):
        pieces = {"".join(rng.choice("ab▁") for _ in range(rng.randrange(1, 4))) for _ in range(6)} - {"<unk>"}
        scores = {p: -float(rng.randrange(1, 4)) for p in pieces}
        vocabulary = [("<unk>", 0.0), *scores.items()]
        own = tokenizers.Tokenizer(tokenizers.models.Unigram(vocabulary, unk_id=0, byte_fallback=False))
        counter = token_counts.Counter(scores | {}, byte_pieces=False)
        counter.unknown = min([0.0, *scores.values()]) - token_counts.UNKNOWN_PENALTY
        for _ in range(20):
            t = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 12)))
            given = "▁" + t.replace(" ", "▁")
            assert counter.count(t) == len(own.encode(given, add_special_tokens=False).ids), (scores, t)


def test_one_word_boundary_rule():
    assert re.split(r"[\x20\x09-\x0D]+", "a\x1cb c") == ["a\x1cb", "c"]
