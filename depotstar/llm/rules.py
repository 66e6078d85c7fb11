"""Quality rules: a table of thresholds compiled into one Spark projection.

Every measure is an SQL expression over the text, its words and its lines, and a rule bounds one
measure. The text is read by Spark's own functions only; no row leaves its task and nothing is
shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANKS = r"[\\x20\\x09-\\x0D]+"
#: Symbols that prose seldom has.
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the languages expected.
STOP_WORDS = {
    "en": "the a an and or of to in is it that with for on as by are be this at not from",
    "de": "der die das und ist ein eine in zu den mit von auf für dem sich des nicht im auch",
    "es": "el la los las y de que en un una es por con para se no del su al como lo",
    "fr": "le la les et de des un une est que en du pour dans qui il par sur au pas ce",
}


@dataclass(frozen=True)
class Rule:
    """Texts whose `measure` is below `least` or above `most` fail; a bound of None is no bound."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: Measures over the counts of `measured`. Those that divide are 0 where there is nothing to divide by.
MEASURES = {
    "words": "n_words",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "exclamations_per_word": "n_exclamations / greatest(n_words, 1)",
    "letter_words": "n_letter_words / greatest(n_words, 1)",
    "stop_words": "n_stop_words",
    "stop_words_per_word": "n_stop_words / greatest(n_words, 1)",
    "repeat_words": "n_repeat_words / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "bullet_lines": "n_bullet_lines / greatest(n_lines, 1)",
    "open_lines": "n_open_lines / greatest(n_lines, 1)",
}

#: A text that fails one of these is dropped whatever the other rules say.
BASE = (
    Rule("few_words", "words", least=50),
    Rule("repeats_itself", "repeat_words", most=0.5),
)

RULES = (
    Rule("short_words", "mean_word_chars", least=2),
    Rule("long_words", "mean_word_chars", most=15),
    Rule("symbols", "symbols_per_word", most=0.1),
    Rule("exclaims", "exclamations_per_word", most=0.2),
    Rule("few_letters", "letter_words", least=0.7),
    Rule("no_stop_words", "stop_words", least=2),
    Rule("rare_stop_words", "stop_words_per_word", least=0.02),
    Rule("repeated_lines", "dup_lines", most=0.4),
    Rule("bullets", "bullet_lines", most=0.9),
    Rule("cut_lines", "open_lines", most=0.3),
)


def _listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


#: Windows of three words as (hash, words, place), and the hashes alone.
_NEXT = "get(_words, i + 1), get(_words, i + 2)"
_EACH = "transform(slice(_words, 1, greatest(size(_words) - 2, 0)), (w, i) ->"
_HASHES = f"{_EACH} xxhash64(w, {_NEXT}))"
_WINDOWS = f"{_EACH} struct(struct(xxhash64(w, {_NEXT}) as h, w, {_NEXT}) as k, i))"


def _counts() -> dict[str, str]:
    """Counts of a text: SQL over its `_text`, `_words`, `_plain` (without case and marks), `_lines`
    and `_windows` (sorted; none if all hashes differ)."""
    stop = sorted({w for words in STOP_WORDS.values() for w in words.split()})
    covered = (
        "flatten(zip_with(_windows, slice(_windows, 2, size(_windows)), (a, b) -> if(a.k = b.k, "
        "array(a.i, a.i + 1, a.i + 2, b.i, b.i + 1, b.i + 2), cast(array() as array<int>))))"
    )
    return {
        "n_words": "size(_words)",
        "word_chars": r"char_length(translate(_text, ' \t\n\u000B\u000C\r', ''))",
        "n_symbols": f"char_length(_text) - char_length(translate(_text, '{SYMBOLS}', ''))",
        "n_exclamations": "char_length(_text) - char_length(translate(_text, '!', ''))",
        "n_letter_words": r"size(filter(_words, w -> w rlike '\\p{L}'))",
        "n_stop_words": f"size(filter(_plain, w -> w in ({_listed(stop)})))",
        "n_lines": "size(_lines)",
        "n_dup_lines": "size(_lines) - size(array_distinct(_lines))",
        "n_bullet_lines": r"size(filter(_lines, l -> l rlike '^[ \\t]*[-*•]'))",
        "n_open_lines": r"size(filter(_lines, l -> l rlike '(…|\\.\\.\\.)[ \\t\\r]*$'))",
        "n_repeat_words": f"if(_windows is null, 0, size(array_distinct({covered})))",
    }


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id under its name and the counts (long) of every whole text; no other column is read.

    Words are what stands between x09-x0D and x20. A NULL text counts as empty and has no words and
    no lines. Lines are those of the text between line feeds that have a word; one is a duplicate if
    it equals an earlier one. Repeated rows are texts of their own, and an empty table gives none.
    A long text is held whole, with its windows, by the one row that it is.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    texts = docs.select(
        F.col(f"`{id_column}`").alias("_id"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("_text"),
    )
    parts = texts.selectExpr(
        "_id", "_text",
        f"filter(split(_text, '{BLANKS}'), w -> w <> '') as _words",
        f"split(translate(_text, '{upper}.,;:!?', '{lower}'), '{BLANKS}') as _plain",
        r"filter(split(_text, '\n'), l -> l rlike '[^\\x20\\x09-\\x0D]') as _lines",
    )
    # Windows are compared by hash first, and by their words only where two hashes are equal; sorted
    # as a column of its own, by compiled code.
    parts = parts.selectExpr("*", f"{_HASHES} as _hashes").selectExpr(
        "*", f"if(size(array_distinct(_hashes)) < size(_hashes), sort_array({_WINDOWS}), null) as _windows"
    )
    counts = [f"cast({e} as long) as {n}" for n, e in _counts().items()]
    return parts.selectExpr(f"_id as `{id_column}`", *counts)


def _fails(rule: Rule) -> str:
    value = MEASURES[rule.measure]
    tests = []
    if rule.least is not None:
        tests.append(f"{value} < {rule.least}D")
    if rule.most is not None:
        tests.append(f"{value} > {rule.most}D")
    return f"({' or '.join(tests) or 'false'})"


def judge(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    base: tuple[Rule, ...] = BASE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The counts of `measured`, base_failed, failed (the names of all failed rules) and kept.

    A text is kept if it fails no rule of `base` and none of `rules`. Empty texts fail the base.
    """
    named = [f"if({_fails(r)}, '{r.name}', null)" for r in (*base, *rules)]
    base_failed = " or ".join(_fails(r) for r in base) or "false"
    any_failed = " or ".join(_fails(r) for r in (*base, *rules)) or "false"
    return measured(docs, id_column, text_column).selectExpr(
        "*", f"{base_failed} as base_failed",
        f"array_compact(cast(array({', '.join(named)}) as array<string>)) as failed",
        f"not ({any_failed}) as kept",
    )
