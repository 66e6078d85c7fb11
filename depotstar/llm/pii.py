"""Personal data: kinds with a fixed form, and more found from the contexts these stand in.

The identifiers of fixed form are seeds. The words around them are lexical patterns. Patterns and
the tokens they surround make a graph, on which Spark scores both in turns: a pattern by the share
of its tokens that are identifiers of a kind, a token by the patterns it is met in. Patterns with
high scores give the kind to the other tokens they surround. Only DataFrame and SQL functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import common

KINDS = ("email", "ip", "card", "phone")

#: The leftmost non-overlapping matches of the plain patterns, written so that Java takes linear
#: time: a match starts at the start of a run of its characters, or where the last one ended, and
#: quantifiers don't give back what could not help.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without this has no valid match.
_NEEDED = {
    "email": r"@[A-Za-z0-9-]+\.", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": r"(?:[0-9][ -]?){14}",
    "phone": r"\+[0-9]",
}
#: What a match x.m must meet, in SQL.
_VALID = {
    "email": "true",
    "ip": r"x.m rlike '^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|(?<=0))(?:\\.|$)){4}'",
    "card": "length(regexp_replace(x.m, '[^0-9]', '')) between 14 and 19"
            " and luhn_check(regexp_replace(x.m, '[^0-9]', ''))",
    "phone": "length(regexp_replace(x.m, '[^0-9]', '')) between 10 and 15",
}
#: Identifiers of fixed form stand in the masked text as one _OPEN and as many _MORE as fill their length.
_OPEN, _MORE = "\ue000", "\ue001"
_PLAIN = rf"[^\s{_OPEN}{_MORE}]"
#: Digit blocks of a word, joined by brackets, dots or hyphens, to the end of the word.
_BLOCKS = r"[0-9]++(?:[().\[\]-]{1,3}+[0-9]++)*+\p{Punct}*+(?!\S)"
#: What could be an identifier: the word of one of fixed form, digit blocks over several words, or a word.
_CANDIDATE = (
    rf"(?:(?<!\S){_PLAIN}*+)?+{_OPEN}{_MORE}*+{_PLAIN}*+"
    rf"|(?<!\S)\p{{Punct}}*+{_BLOCKS}(?:(?<=[0-9)\]-])[ ]{{1,3}}+(?:-[ ]++)?+[(\[]*+{_BLOCKS})*+"
    rf"|(?<!\S){_PLAIN}*[0-9@]{_PLAIN}*+(?![{_OPEN}{_MORE}])"
)

_SPAN = "struct<start:int,end:int,kind:string>"
_OCCURRENCE = (
    "struct<start:int,end:int,token:string,seed:string,before2:string,before:string,after:string>"
)


def _parts(pattern: str, needed: str, column: str = "text") -> tuple[Column, Column]:
    """Matches in `column`, and the pieces between them."""
    there = F.col(column).rlike(needed)
    none = F.array().cast("array<string>")
    return (
        F.when(there, F.regexp_extract_all(column, F.lit(pattern), F.lit(0))).otherwise(none),
        F.when(there, F.split(column, pattern, -1)).otherwise(none),
    )


def _located(matches: str, pieces: str, kind: str, made: str) -> str:
    """SQL: the array of `made` for each match, x.m at character x.a and number i, in order."""
    return f"""
        aggregate(
            if(size({matches}) = 0, cast(array() as array<int>), sequence(0, size({matches}) - 1)),
            named_struct('at', 0, 'out', cast(array() as array<{kind}>)),
            (s, i) -> named_struct(
                'at', s.at + length({pieces}[i]) + length({matches}[i]),
                'out', concat(s.out, transform(
                    array(named_struct('a', s.at + length({pieces}[i]), 'm', {matches}[i])),
                    x -> {made}
                ))
            )
        ).out"""


def _base_spans(kind: str) -> str:
    made = f"named_struct('start', x.a, 'end', x.a + length(x.m), 'kind', if({_VALID[kind]}, '{kind}', null))"
    return f"filter({_located(f'{kind}_m', f'{kind}_p', _SPAN, made)}, s -> s.kind is not null)"


def _apart() -> Column:
    """Of the spans in `base`, those that no earlier one of them overlaps."""
    return F.expr(f"""
        aggregate(
            base, named_struct('at', 0, 'out', cast(array() as array<{_SPAN}>)),
            (s, x) -> if(x.start < s.at, s, named_struct('at', x.end, 'out', concat(s.out, array(x))))
        ).out""")


def _masked() -> Column:
    """`text` with the spans in `apart` masked; all other characters keep their places."""
    marks = f"{_OPEN}{_MORE}"
    plain = f"if(text rlike '[{marks}]', translate(text, '{marks}', '??'), text)"
    return F.expr(f"""
        if(size(apart) = 0, {plain}, aggregate(
            apart, named_struct('at', 0, 'out', cast(array() as array<string>)),
            (s, x) -> named_struct('at', x.end, 'out', concat(s.out, array(
                substring({plain}, s.at + 1, x.start - s.at), '{_OPEN}',
                repeat('{_MORE}', x.end - x.start - 1)))),
            s -> concat(array_join(s.out, ''), substring({plain}, s.at + 1))
        ))""")


def _first_word(text: str, after: int = 0) -> str:
    """SQL: the word that comes first in a text, or after one other; NULL if there is none."""
    skipped = r"\\S++\\s++" * after
    return rf"nullif(regexp_extract({text}, '^\\s*+{skipped}(\\S++)', 1), '')"


def _last_word(text: str, before: int = 0) -> str:
    """SQL: the word that comes last, found from the end, so that a long text costs no search."""
    return f"reverse({_first_word(f'reverse({text})', before)})"


def _occurrences() -> str:
    # A bracket is kept in front where the candidate goes on behind its closing one.
    lead = r"regexp_replace(x.m, '^(?:[\\p{Punct}&&[^+(]]|[(](?![^()]*[)][^()]*[A-Za-z0-9]))+', '')"
    core = rf"regexp_replace({lead}, '\\p{{Punct}}+$', '')"
    start = f"x.a + length(x.m) - length({lead})"
    before = "concat(if(i > 0, '§ ', '^ '), c_p[i])"
    after = "concat(c_p[i + 1], if(i + 1 < size(c_m), ' §', ' $'))"
    at = f"x.a + locate('{_OPEN}', x.m) - 1"
    long = f"length(regexp_replace(x.m, '[^{_OPEN}{_MORE}]+', ''))"
    context = (
        f"'before2', lower({_last_word(before, 1)}), 'before', lower({_last_word(before)}),"
        f" 'after', lower({_first_word(after)})"
    )
    made = (
        f"if(locate('{_OPEN}', x.m) > 0,"
        f" named_struct('start', {at}, 'end', {at} + {long}, 'token', substring(text, {at} + 1, {long}),"
        f" 'seed', get(filter(apart, s -> s.start = {at}), 0).kind, {context}),"
        f" named_struct('start', {start}, 'end', {start} + length({core}), 'token', {core},"
        f" 'seed', cast(null as string), {context}))"
    )
    return f"filter({_located('c_m', 'c_p', _OCCURRENCE, made)}, o -> o.token rlike '[0-9@]')"


def find_base(docs: DataFrame) -> DataFrame:
    """All columns of `docs`, with base (spans of fixed form) and tokens (other candidates).

    `docs` has a column `text` without NULLs.
    """
    parts = {}
    for kind in KINDS:
        parts[f"{kind}_m"], parts[f"{kind}_p"] = _parts(PATTERNS[kind], _NEEDED[kind])
    kept = docs.columns
    found = docs.select("*", *[c.alias(n) for n, c in parts.items()])
    found = found.select(*kept, F.expr(f"concat({', '.join(map(_base_spans, KINDS))})").alias("base"))
    found = found.withColumn("base", _ordered("base")).withColumn("apart", _apart())
    found = found.withColumn("masked", _masked())
    matches, pieces = _parts(_CANDIDATE, f"[0-9@{_OPEN}]", "masked")
    found = found.select(*kept, "base", "apart", matches.alias("c_m"), pieces.alias("c_p"))
    return found.select(*kept, "base", F.expr(_occurrences()).alias("tokens"))


def _ordered(spans: str) -> Column:
    """Spans by start, then kind as listed, then end."""
    rank = f"array_position(array({', '.join(repr(k) for k in KINDS)}), s.kind)"
    return F.expr(
        f"transform(array_sort(transform({spans}, s -> struct(s.start as start, {rank} as rank, s.end as end, s.kind as kind))),"
        " s -> struct(s.start as start, s.end as end, s.kind as kind))"
    )


def _joined(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def _edges(found: DataFrame) -> DataFrame:
    """uid, start, end, token, pattern and seed of each candidate and each of its contexts.

    A seed is an identifier of fixed form as a whole, and `seed` its kind. Other tokens that such an
    identifier covers are left out. Contexts without letters say nothing.
    """
    tokens = found.select("uid", "base", F.explode("tokens").alias("o")).select(
        "uid", "o.*", F.expr("exists(base, s -> s.start < o.end and s.end > o.start)").alias("covered"),
    ).where("seed is not null or not covered")
    shape = r"regexp_replace(regexp_replace(token, '[0-9]+', '0'), '[A-Za-z]+', 'a')"
    wordy = r"{0} rlike '\\p{{L}}'"
    b, b2, a = (wordy.format(c) for c in ("before", "before2", "after"))
    patterns = (
        "filter(array("
        f"if({b} and {b2}, concat('two before: ', before2, ' ', before), null),"
        f"if({b} and {a}, concat('around: ', before, ' _ ', after), null),"
        f"if({b}, concat('before, form: ', before, ' ', {shape}), null)"
        "), p -> p is not null)"
    )
    return tokens.select(
        "uid", "start", "end", "token", "seed", F.explode(F.expr(patterns)).alias("pattern")
    )


def score_patterns(edges: DataFrame, turns: int, least: float, support: int) -> DataFrame:
    """pattern, kind and score of the patterns that tell a kind.

    Counts are of different tokens, so copies of a text add nothing. A pattern's score for a kind is
    the sum of its tokens' scores over their number plus one; it has one from `support` known tokens
    on. Known are the seeds, whose score is one, and, as soon as they have it, tokens that score at
    least `least`: so what one pattern discovers supports the next. A token's score is that of a
    noisy or over its patterns. Each turn looks up the tokens that became known in the turn before.
    """
    graph = stage(edges.groupBy("pattern", "token").agg(F.max("seed").alias("seed")), "graph")
    seeds = stage(
        graph.where("seed is not null").select("token", F.col("seed").alias("kind")).distinct()
        .withColumn("score", F.lit(1.0)), "seeds",
    )
    sizes = graph.groupBy("pattern").agg(F.count("*").alias("n"))
    counts = stage(
        graph.where("seed is not null").groupBy("pattern", F.col("seed").alias("kind")).agg(
            F.count("*").alias("known")
        ), "counts",
    )
    supported = stage(counts.where(F.col("known") >= support).select("pattern", "kind"), "supported")

    def edges_of(patterns: DataFrame) -> DataFrame:
        return stage(
            graph.join(patterns, "pattern").join(sizes.join(patterns.select("pattern").distinct(), "pattern"), "pattern")
            .select("pattern", "kind", "n", "token"), "own",
        )

    own, scores, known = edges_of(supported), seeds, seeds.select("token", "kind")
    for turn in range(turns):
        patterns = own.join(scores, ["token", "kind"]).groupBy("pattern", "kind").agg(
            (F.sum("score") / (F.first("n") + 1)).alias("score")
        )
        patterns = stage(patterns, "patterns")
        if turn + 1 == turns:
            break
        met = own.join(patterns, ["pattern", "kind"]).groupBy("token", "kind").agg(
            (1 - F.exp(F.sum(F.log1p(-F.col("score"))))).alias("met")
        )
        scores = stage(
            met.join(seeds, ["token", "kind"], "full").select(
                "token", "kind", F.coalesce("score", "met").alias("score")
            ), "scores",
        )
        fresh = scores.where(F.col("score") >= least).select("token", "kind").join(known, ["token", "kind"], "left_anti")
        fresh = stage(fresh, "fresh")
        if fresh.isEmpty():
            continue
        known = known.union(fresh)
        more = graph.join(fresh, "token").groupBy("pattern", "kind").agg(F.count("*").alias("known"))
        counts = stage(
            counts.unionByName(more).groupBy("pattern", "kind").agg(F.sum("known").alias("known")), "counts"
        )
        new = counts.where(F.col("known") >= support).select("pattern", "kind").join(
            supported, ["pattern", "kind"], "left_anti"
        )
        new = stage(new, "supported")
        supported = supported.union(new)
        own = own.union(edges_of(new))
    return patterns.where(F.col("score") >= least).groupBy("pattern").agg(
        F.max(F.struct("score", "kind")).alias("best")
    ).select("pattern", "best.kind", "best.score")


def find(
    docs: DataFrame, turns: int = 3, least: float = 0.8, support: int = 3, keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, base, added and spans (arrays of start, end, kind) of each row of `docs`.

    Places count characters (code points), from 0, end exclusive. base has the leftmost
    non-overlapping matches of each fixed form; added has tokens met in patterns that score at least
    `least`, where no base span is; spans has both. All are ordered by start, then kind. `turns`
    is how often patterns are scored, `support` how many different seeds a pattern needs.

    A NULL text counts as empty and has no spans; an empty table has no rows. Rows with equal or NULL
    doc_id are rows of their own, but repeated rows give a pattern no more tokens. Of patterns with
    equal scores the greater kind by name counts; a score of exactly `least` and a number of seeds of
    exactly `support` are enough. A text of any length is searched whole by the task that has its
    row; contexts are whole words, however long. Further columns are read only if named in `keep`,
    which are handed through.
    """
    given = docs.select(
        "doc_id", *keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("uid", F.monotonically_increasing_id())
    found = find_base(given)
    found = stage(found if keep else found.drop("text"), "found")
    edges = _edges(found)
    patterns = score_patterns(edges, turns, least, support)
    added = (
        edges.where("seed is null").join(patterns, "pattern")
        .groupBy("uid", "start", "end").agg(F.max(F.struct("score", "kind")).alias("best"))
        .groupBy("uid").agg(F.collect_list(F.struct("start", "end", "best.kind")).alias("added"))
    )
    none = F.array().cast(f"array<{_SPAN}>")
    return (
        found.drop("tokens").join(added, "uid", "left").drop("uid")
        .withColumn("added", F.coalesce("added", none))
        .withColumn("added", _ordered("added")).withColumn("spans", _ordered("concat(base, added)"))
    )


def digests(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans as text, from find()."""
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"),
        F.size("added").cast("bigint").alias("n_added"),
    )


def redact(docs: DataFrame, **finding) -> DataFrame:
    """All rows and columns of `docs`, personal data in `text` replaced by its kind: [EMAIL], ...

    Of spans that overlap, the first names the place; a NULL text stays NULL.
    """
    # The text is carried once, beside the row of the other columns.
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    row = F.struct(*rest, F.col("text").isNotNull().alias("text"))
    given = docs.select("doc_id", "text", row.alias("row"))
    found = find(given, keep=("row",), **finding)
    text = F.expr("""
        aggregate(
            spans, named_struct('at', 0, 'out', cast(array() as array<string>)),
            (s, x) -> if(x.start < s.at,
                named_struct('at', greatest(s.at, x.end), 'out', s.out),
                named_struct('at', x.end, 'out', concat(s.out, array(
                    substring(text, s.at + 1, x.start - s.at), concat('[', upper(x.kind), ']')))))
            , s -> concat(array_join(s.out, ''), substring(text, s.at + 1))
        )
    """)
    text = F.when(F.col("row")["text"], text)
    return found.select([
        text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns
    ])
