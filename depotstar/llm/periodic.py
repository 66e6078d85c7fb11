"""Runs of repeated words, by a dictionary of basic factors.

For every power of two L, the dictionary names the stretches of L words so that equal stretches have
equal names. Occurrences of a name that are at most L / 2 apart form an arithmetic progression, whose
difference is the smallest period of that stretch; further progressions begin more than L / 2 later,
so at most three begin within twice the length. A run of smallest period q, L <= q < 2 L, repeats
the stretch at its start q words later, in another progression:

- if the periodicity of the first progression breaks inside the run, it breaks q words later, too,
  and the last members of both progressions are q apart;
- otherwise the later progression begins q words after the start of the run.

So all runs are proposed by the distances between last members, and from each member to the first
of the next progressions. A proposal is extended to both sides by binary steps through the
dictionary; equal stretches are one run, of the smallest period proposed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Words whose dictionaries are made together; a text with more has one of its own.
BLOCK = 1 << 18
#: No more progressions begin within twice the length of a stretch.
NEXT = 3

RUN = "struct<start: long, length: long, period: long>"


class Factors:
    """The dictionary of a sequence of non-negative numbers.

    A stretch that occurs once has no name; its place is negative and its own. Levels end where no
    stretch occurs twice, so ordinary texts have few.
    """

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.levels: list[np.ndarray] = []
        named = self._named(np.arange(self.n), words.astype(np.int64), self.n)
        while (named >= 0).any():
            self.levels.append(named)
            length = 1 << len(self.levels) - 1
            if 2 * length > self.n:
                break
            a, b = named[:-length], named[length:]
            at = np.flatnonzero((a >= 0) & (b >= 0))
            named = self._named(at, a[at].astype(np.int64) * self.n + b[at], self.n)

    @staticmethod
    def _named(at: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
        """Names by place: equal keys get the number of the key, keys that occur once none."""
        names = -1 - np.arange(n, dtype=np.int32)
        if len(at):
            _, number, count = np.unique(keys, return_inverse=True, return_counts=True)
            again = count[number] > 1
            names[at[again]] = number[again]
        return names

    def common_ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common stretch that starts at i and at j, i < j."""
        done = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.levels))):
            names, step = self.levels[k], 1 << k
            # The highest level may fit any number of times, lower ones once.
            live = np.arange(len(i))
            while len(live):
                a, b = i[live] + done[live], j[live] + done[live]
                live, a, b = (x[b < self.n] for x in (live, a, b))
                live = live[names[a] == names[b]]
                done[live] += step
                if k < len(self.levels) - 1:
                    break
        return done

    def common_behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common stretch that ends before i and before j, i < j."""
        done = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.levels))):
            names, step = self.levels[k], 1 << k
            live = np.arange(len(i))
            while len(live):
                a, b = i[live] - done[live] - step, j[live] - done[live] - step
                live, a, b = (x[a >= 0] for x in (live, a, b))
                live = live[names[a] == names[b]]
                done[live] += step
                if k < len(self.levels) - 1:
                    break
        return done

    def proposals(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, period) proposed by the stretches of 2 ** k words; periods from L to 2 L - 1."""
        names, length = self.levels[k], 1 << k
        at = np.flatnonzero(names >= 0)
        at = at[np.argsort(names[at], kind="stable")]
        name = names[at]
        same = name[1:] == name[:-1]
        chained = same & (np.diff(at) <= length // 2)
        # Places in progressions: number of each place's progression, first and last of each.
        starts = np.flatnonzero(np.r_[True, ~chained])
        chain = np.cumsum(np.r_[True, ~chained]) - 1
        first, last = at[starts], at[np.r_[starts[1:], len(at)] - 1]
        of = name[starts]
        places, periods = [], []

        def propose(place: np.ndarray, period: np.ndarray) -> None:
            fits = (period >= length) & (period < 2 * length)
            places.append(place[fits])
            periods.append(period[fits])

        for ahead in range(1, NEXT + 1):
            a = np.arange(max(len(starts) - ahead, 0))
            a = a[of[a] == of[a + ahead]]
            propose(last[a], last[a + ahead] - last[a])
            b = chain + ahead
            m = np.flatnonzero(b < len(starts))
            m = m[of[b[m]] == name[m]]
            propose(at[m], first[b[m]] - at[m])
        return np.concatenate(places), np.concatenate(periods)

    def runs(self, least: int) -> np.ndarray:
        """(start, length, period) of all runs of at least `least` words, by start, then period."""
        found = [np.zeros((0, 3), np.int64)]
        for k in range(len(self.levels)):
            i, period = self.proposals(k)
            if not len(i):
                continue
            # A run is proposed from many places; beside an equal proposal one place is enough.
            start = i - self.common_behind(i, i + period)
            pairs = np.unique(np.stack([start, period], 1), axis=0)
            start, period = pairs[:, 0], pairs[:, 1]
            length = period + self.common_ahead(start, start + period)
            keep = (length >= 2 * period) & (length >= least)
            found.append(np.stack([start, length, period], 1)[keep])
        rows = np.concatenate(found)
        rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
        # A multiple of a run's smallest period is a period of the same stretch.
        fresh = np.r_[True, (np.diff(rows[:, :2], axis=0) != 0).any(1)] if len(rows) else []
        rows = rows[np.asarray(fresh, bool)]
        return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _blocks(texts: list[bytes]) -> Iterator[list[list[bytes]]]:
    """The words of the texts, in blocks of about BLOCK words."""
    block, size = [], 0
    for text in texts:
        words = text.split()
        if block and size + len(words) > BLOCK:
            yield block
            block, size = [], 0
        block.append(words)
        size += len(words)
    if block:
        yield block


def block_runs(block: list[list[bytes]], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of all texts of a block, and for each run the number of its text.

    Equal words have one number within their text only, and texts are kept apart by a number of
    their own, so nothing repeats across texts.
    """
    numbers, offsets, fresh = [], [], 0
    for words in block:
        offsets.append(len(numbers))
        seen: dict[bytes, int] = {}
        numbers.extend([fresh + seen.setdefault(w, len(seen)) for w in words])
        fresh += len(seen) + 1
        numbers.append(fresh - 1)
    runs = Factors(np.array(numbers, np.int64)).runs(least)
    own = np.searchsorted(np.array(offsets), runs[:, 0], "right") - 1
    runs[:, 0] -= np.array(offsets)[own]
    return runs, own


def kept_words(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not len(runs):
        return words
    start, length, period = runs.T
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]


def periodic_runs(
    docs: DataFrame, least_words: int = 12, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The id under its name, runs and collapsed (text) of every row.

    Words are what stands between x09-x0D and x20; words that differ in case differ. A run is a
    stretch of words with smallest period q, of at least `least_words` and 2 q words, that no
    neighbouring word extends; `runs` holds them by start, then period, in words from 0. Runs may
    overlap and lie within each other. `collapsed` has the words that no run holds after its first q
    words, joined by a space. A NULL text counts as empty; empty texts have no run and an empty
    `collapsed`. Rows that repeat are texts of their own, an empty table gives none, and no other
    column is read. A text is handled whole, whatever its length, in memory of its words times
    the levels at which stretches repeat.
    """
    common.prepare(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for block in _blocks(common.text_bytes(batch)):
                runs, own = block_runs(block, least_words)
                cuts = np.searchsorted(own, np.arange(len(block) + 1))
                texts = [
                    b" ".join(kept_words(words, runs[a:b])).decode()
                    for words, a, b in zip(block, cuts, cuts[1:])
                ]
                columns = [pa.array(runs[:, i], pa.int64()) for i in range(3)]
                rows = pa.StructArray.from_arrays(columns, ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(at, len(block)),
                     pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), rows),
                     pa.array(texts, pa.string())],
                    names=["id", "runs", "collapsed"],
                )
                at += len(block)

    given = common.id_and_text(docs, id_column, text_column)
    kind = given.schema["id"].dataType.simpleString()
    found = given.mapInArrow(of, f"id {kind}, runs array<{RUN}>, collapsed string")
    return found.withColumnRenamed("id", id_column)
