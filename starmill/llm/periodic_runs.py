"""Periodic runs of words, by an online sparse diagonal DP.

A run of period q is a stretch of a diagonal: its words equal those q places before.  Words are read in order;
a word's earlier occurrence at lag q increments the match length of the active diagonal q, and a
diagonal that ends with sufficient length gives its run at once.  Frequent words have many earlier
occurrences, most of which lead nowhere.  So lags are taken by classes lo..hi (hi = 1.5 lo), and an occurrence
counts only if the next 3 lo words are equal too.  That context is at least 2 hi words long, hence the nearest
such occurrence decides: inside a run of smallest period q it is exactly q places back (two periods
that overlap so far would have a common smaller one), and where it is nearer the run has that smaller
period.  Every place thus has one lag for each class, a run lasts as long as the lag does, and the
work is n log n whatever the words.  A run of period q has 3 q equal places, so the context never misses it.

Equal contexts are found by names: a word's name is its number in the text, the name of twice as many words
that of a pair of names.  Places whose name does not recur leave, which is nearly all after a few words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import add_columns, claim_memory

MIN_LENGTH, MIN_EXPONENT = 6, 4
# Words of whole texts that are looked at together; a longer text is by itself.
_SLICE = 1 << 17
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def lag_classes(longest: int) -> Iterator[tuple[int, int, int]]:
    """Smallest and largest lag of each class, and the words of context, for texts of at most ``longest`` words."""
    lo = 1
    while MIN_EXPONENT * lo <= longest:
        hi = lo + lo // 2
        yield lo, hi, 3 * lo
        lo = hi + 1


def _paired(names: np.ndarray, places: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (of those given) where a pair of names ``step`` apart recurs, ascending; the pair's name; the lag to the last one.

    A lag of 0 stands for a first occurrence.  A name below 0 recurs nowhere.
    """
    places = places[places < len(names) - step]
    second = names[places + step]
    places, second = places[second >= 0], second[second >= 0]
    key = names[places] * len(names) + second
    order = np.argsort(key, kind="stable")
    key, at = key[order], places[order]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[1:] == key[:-1]
    again = same[:-1] | same[1:]
    lag = np.where(same[:-1], np.diff(at, prepend=0), 0)
    name = np.cumsum(~same[:-1]) - 1
    back = np.argsort(at[again], kind="stable")
    return at[again][back], name[again][back], lag[again][back]


def diagonals(names: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, length, period) of all runs in a row of names; a name below 0 recurs nowhere."""
    names, width, found = names.copy(), 1, [np.zeros((0, 3), np.int64)]
    places = np.flatnonzero(names >= 0)
    for lo, hi, context in lag_classes(longest):
        while 2 * width <= context:
            places, name, _ = _paired(names, places, width)
            names = np.full(len(names), -1)
            names[places] = name
            width *= 2
        at, _, lag = _paired(names, places, context - width)
        if not len(at):
            break
        active = (lag >= lo) & (lag <= hi)
        i, q = at[active], lag[active]
        begins = np.ones(len(i), bool)  # of a diagonal; the place before has another lag or none
        begins[1:] = (np.diff(i) > 1) | (np.diff(q) != 0)
        first = np.flatnonzero(begins)
        matches = np.diff(first, append=len(i)) + context - 1
        length = matches + q[first]
        enough = length >= np.maximum(MIN_LENGTH, MIN_EXPONENT * q[first])
        found.append(np.stack([i[first] - q[first], length, q[first]], axis=1)[enough])
        places = places[np.isin(places, at, assume_unique=True)]
    return np.concatenate(found)


def _some(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Runs of each of a few texts, by start and period."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    names = np.full(int(ends[-1]), -1)  # a text ends with a name that recurs nowhere
    given = 0
    for words, end in zip(texts, ends.tolist()):
        number: dict[bytes, int] = {}
        own = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
        again = np.bincount(own, minlength=1)[own] > 1 if len(own) else own.astype(bool)
        names[end - 1 - len(own):end - 1] = np.where(again, own + given, -1)
        given += len(number)
    runs = diagonals(names, max(map(len, texts)))
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    owner = np.searchsorted(ends, runs[:, 0], side="right")
    runs[:, 0] -= np.concatenate([[0], ends])[owner]
    return np.split(runs, np.searchsorted(owner, np.arange(1, len(texts))))


def runs_of(texts: list[list[bytes]]) -> Iterator[np.ndarray]:
    """Rows (start, length, period) of the runs of each text, by start and period."""
    some: list[list[bytes]] = []
    held = 0
    for words in texts:
        if some and held + len(words) > _SLICE:
            yield from _some(some)
            some, held = [], 0
        some.append(words)
        held += len(words) + 1
    if some:
        yield from _some(some)


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run has after its first period, joined by blanks."""
    if len(runs):
        step = np.zeros(len(words) + 1, np.int64)
        np.add.at(step, runs[:, 0] + runs[:, 2], 1)
        np.add.at(step, runs[:, 0] + runs[:, 1], -1)
        words = [w for w, covered in zip(words, np.cumsum(step).tolist()) if not covered]
    return b" ".join(words)


def with_runs(df: DataFrame, text: str = "text", runs: str = "runs", rest: str = "collapsed") -> DataFrame:
    """All columns of ``df``, the runs of the text's words and the text without their repetitions.

    Words are what blanks and the controls 9 to 13 separate, numbered from 0.  ``runs`` is an array of (start,
    length, period) by start and period: stretches of smallest period q and at least max(MIN_LENGTH, MIN_EXPONENT * q) words that no
    neighbouring word extends.  ``rest`` has the words that no run holds after its first period, joined by one blank.
    A null or empty text has no words, no runs and an empty rest.  Rows are independent, so repeated rows
    have equal results; a very long text takes some 100 bytes a word in one task.  Columns of the new names are replaced;
    an empty table gives an empty result.
    """
    def add(texts: list[str | None]) -> dict[str, pa.Array]:
        claim_memory(runs_of)
        words = [(t or "").encode().split() for t in texts]
        found = list(runs_of(words))
        rows = [[dict(zip(("start", "length", "period"), r)) for r in f.tolist()] for f in found]
        left = [collapsed(w, f).decode() for w, f in zip(words, found)]
        return {runs: pa.array(rows, _RUNS), rest: pa.array(left, pa.string())}

    new = {runs: "array<struct<start:bigint,length:bigint,period:bigint>>", rest: "string"}
    return add_columns(df.drop(runs, rest), new, add, text)


def repeated_from(text: Column, start: Column, period: Column) -> Column:
    """The text's words joined by blanks, where from word ``start(n)`` on the first ``period(n)`` words repeat; n words in all."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def of(w: Column) -> Column:
        a, p = start(F.size(w)), period(F.size(w))
        return F.array_join(F.transform(w, lambda word, i: F.when(i < a, word).otherwise(F.get(w, (a + (i - a) % p).cast("int")))), " ")

    return F.element_at(F.transform(F.array(words), of), 1)
