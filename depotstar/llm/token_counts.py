"""Token counts of a unigram vocabulary: Viterbi that carries scores and piece counts only.

An Aho-Corasick automaton lists the vocabulary's pieces that end at each character. For each end,
the best score so far and its number of pieces are kept; the segmentation itself is never built.
Ties go to the piece that starts first, as in the unigram tokenizers of `sentencepiece` and
`tokenizers`, which let a later start win only by a higher score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

#: What stands for a blank in the vocabulary.
BLANK = "▁"
#: An unknown character scores this much below the vocabulary's lowest score.
UNKNOWN_PENALTY = 10.0
_REMEMBERED = 400_000


class Counter:
    """Counts pieces by the vocabulary of a sentencepiece model file and its scores.

    Texts are taken as they are, with blanks (U+0020) as BLANK and one more at the front. Characters
    in no piece count one for each of their bytes, if the vocabulary has byte pieces, else one for
    each run of them. No piece may hold a BLANK behind another character: then the best
    segmentation is the best of each word with the blanks before it, and words are remembered.
    """

    _made: dict[str, Counter] = {}

    @classmethod
    def at(cls, path: str) -> Counter:
        if path not in cls._made:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            ids = range(model.get_piece_size())
            cls._made[path] = cls(
                {model.id_to_piece(i): model.get_score(i) for i in ids
                 if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))},
                any(model.is_byte(i) for i in ids),
            )
        return cls._made[path]

    def __init__(self, scores: dict[str, float], byte_pieces: bool):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            self.automaton.add_word(piece, (len(piece), float(score)))
        self.automaton.make_automaton()
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.byte_pieces = byte_pieces
        self.splits = not any(BLANK in p.lstrip(BLANK) for p in scores)
        self.known: dict[str, int] = {}

    def whole(self, text: str) -> int:
        """Pieces of the best segmentation of a text that has its BLANKs already."""
        best, count, unknown_before = [0.0], [0], False
        total, pieces, single = None, 0, False  # of the end after those in `best`

        def close(total, pieces, single, unknown_before):
            """Add the current end; without a piece of one character there is an unknown one."""
            if not single and (total is None or best[-1] + self.unknown > total):
                if self.byte_pieces:
                    pieces = count[-1] + len(text[len(best) - 1].encode())
                else:
                    pieces = count[-1] + (not unknown_before)
                total, unknown_before = best[-1] + self.unknown, True
            else:
                unknown_before = False
            best.append(total)
            count.append(pieces)
            return unknown_before

        # The automaton goes by ends, and at an end by starts.
        for last, (length, score) in self.automaton.iter(text):
            while len(best) <= last:
                unknown_before = close(total, pieces, single, unknown_before)
                total, single = None, False
            candidate = best[last + 1 - length] + score
            single = single or length == 1
            if total is None or candidate > total:
                total, pieces = candidate, count[last + 1 - length] + 1
        while len(best) <= len(text):
            unknown_before = close(total, pieces, single, unknown_before)
            total, single = None, False
        return count[-1]

    def _remember(self, word: str) -> int:
        n = self.whole(BLANK + word)
        if len(self.known) < _REMEMBERED:
            self.known[word] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        # Without byte pieces, a run of unknown characters may pass over a blank.
        if not self.splits or not self.byte_pieces:
            return self.whole(BLANK + text.replace(" ", BLANK))
        get, remember = self.known.get, self._remember
        total, front = 0, BLANK
        for word in text.split(" "):
            if word:
                if front != BLANK or BLANK in word:
                    total += self.whole(front + word)
                else:
                    n = get(word)
                    total += remember(word) if n is None else n
                front = BLANK
            else:
                front += BLANK
        if len(front) > 1:
            total += self.whole(front[1:])
        return total


def _counts_of(path: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter.at(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.array([counter.count(t) for t in texts], np.int64)),
                 pa.array(np.array([len(t) for t in texts], np.int64))],
                names=["doc_id", "n_tokens", "n_chars"],
            )

    return rows


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens and n_chars of each row of `docs` (doc_id, text).

    A NULL text counts as empty, and an empty text has no tokens. Rows are neither merged nor lost,
    and doc_id may be NULL. Further columns are not read.
    """
    common.prepare(docs.sparkSession)
    given = common.id_and_text(docs, "doc_id", "text")
    return given.mapInArrow(
        _counts_of(model_path),
        f"doc_id {given.schema['id'].dataType.simpleString()}, n_tokens long, n_chars long",
    )
