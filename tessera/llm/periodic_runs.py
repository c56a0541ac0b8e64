"""Periodic run detection (operator 12).

A run is a stretch of words that repeats itself with a period. Seeds are
k-grams of the least overlap that a run guarantees: a run of period q and at
least four periods agrees with itself, shifted by q, over three periods. Equal
k-grams of a document whose distance lies in their class of lags are seeds;
each is extended along its diagonal, and a table of the furthest place covered
at each lag keeps one stretch from being extended twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textblocks import BLOCK_BYTES, Words, find_words


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each key's value, whether the value occurs again)."""
    _, name, count = np.unique(key, return_inverse=True, return_counts=True)
    return name, count[name] > 1


def _longer(name: np.ndarray, shift: int) -> np.ndarray:
    """Names of the joined stretches at i and i + shift, -1 where either has
    none or the joined one occurs only once."""
    out = np.full(len(name), -1, np.int64)
    at = np.flatnonzero(name[:len(name) - shift] >= 0) if shift < len(name) else np.empty(0, np.int64)
    at = at[name[at + shift] >= 0]
    if len(at):
        joined, again = _groups(name[at] * (int(name.max()) + 1) + name[at + shift])
        out[at[again]] = joined[again]
    return out


def _seeds(x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, lag) of the seeds, one class of lags after the other.

    Lags from L to 2L - 1 have k-grams of 3L words: as k is at least the lag,
    the k-gram next occurs exactly one period later inside a run, so that
    consecutive occurrences are enough."""
    name, again = _groups(x)
    name = np.where(again, name, -1)
    size = 1
    while (name >= 0).any():
        twice = _longer(name, size)  # stretches of 2L words
        three = _longer(twice, size)  # of 3L
        at = np.flatnonzero(three >= 0)
        at = at[np.argsort(three[at], kind="stable")]
        lag = np.diff(at)
        ok = (np.diff(three[at]) == 0) & (lag >= size) & (lag < 2 * size)
        yield at[:-1][ok], lag[ok]
        name, size = twice, 2 * size


def _agree(x: np.ndarray, a: int, b: int, step: int) -> int:
    """How far x[a], x[a + step] ... agrees with x[b], x[b + step] ... (a < b)."""
    n, look = 0, 64
    most = len(x) - b if step > 0 else a + 1
    while n < most:
        m = min(look, most - n)
        if step > 0:
            differ = np.flatnonzero(x[a + n:a + n + m] != x[b + n:b + n + m])
        else:
            differ = np.flatnonzero(x[a - n - m + 1:a - n + 1][::-1] != x[b - n - m + 1:b - n + 1][::-1])
        if len(differ):
            return n + int(differ[0])
        n, look = n + m, look * 2
    return n


def find_runs(x: np.ndarray, least: int = 4, shortest: int = 6) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of ``least`` periods (4 or more)
    and ``shortest`` items or more in ``x``, by start and period."""
    runs = []
    for at, lag in _seeds(x):
        order = np.lexsort((at, lag))
        at, lag = at[order], lag[order]
        follows = np.zeros(len(at), bool)  # the seed before it lies on the same diagonal, one place back
        follows[1:] = (np.diff(at) == 1) & (np.diff(lag) == 0)
        furthest: dict[int, int] = {}  # by lag: the first place not covered yet
        for i, q in zip(at[~follows].tolist(), lag[~follows].tolist()):
            if i < furthest.get(q, 0):
                continue
            right = _agree(x, i, i + q, 1)
            left = _agree(x, i - 1, i + q - 1, -1)
            furthest[q] = i + right
            length = left + right + q
            if length >= max(shortest, least * q):
                runs.append((i - left, length, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _rows(words: Words, least: int, shortest: int) -> dict[str, list]:
    classes, _ = words.classes()
    # a word of another document is another item: no run crosses documents
    _, x = np.unique(classes * max(words.n_docs, 1) + words.doc, return_inverse=True)
    counts = words.per_doc()
    base = np.cumsum(counts) - counts
    cover = np.zeros(len(x) + 1, np.int64)
    out: dict[str, list] = {c: [[] for _ in range(words.n_docs)] for c in ("starts", "lengths", "periods")}
    for s, n, q in find_runs(x, least, shortest):
        d = int(words.doc[s])
        out["starts"][d].append(s - int(base[d]))
        out["lengths"][d].append(n)
        out["periods"][d].append(q)
        cover[s + q] += 1
        cover[s + n] -= 1
    return {"n_words": counts.tolist(), **out, "collapsed": words.joined(np.cumsum(cover[:-1]) == 0)}


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 4,
                  shortest: int = 6) -> DataFrame:
    """id_col, n_words, runs (array of start, length, period), collapsed.

    A run is a stretch of consecutive words with smallest period q, at least
    ``least`` periods (4 or more) and ``shortest`` words long, that no
    neighbouring word extends with period q. Runs are ordered by start, then
    period, and counted in words from 0. ``collapsed`` is the text without the
    words that a run holds after its first q ones, the others joined by one
    space. Words are what stands between blanks, tabs and line breaks.

    A null or empty text has no words, no runs and an empty collapsed text.
    Every row is a document of its own, also one that repeats another's id;
    a null id stays null; an empty table stays empty. A long text is one
    row's work of n log n. Other columns are never read."""
    src = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    kind = docs.schema[id_col].dataType

    def found(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in it:
            texts = [t or b"" for t in batch["text"]]
            held = np.cumsum([len(t) + 1 for t in texts]) // BLOCK_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(held)) + 1).tolist(), len(texts)]
            for a, b in zip(cuts, cuts[1:]):
                if a < b:
                    yield pd.DataFrame({"id": batch["id"].iloc[a:b].to_numpy(),
                                        **_rows(find_words(texts[a:b]), least, shortest)})

    rows = src.mapInPandas(found, "id string, n_words long, starts array<long>, lengths array<long>, periods array<long>,"
                                  " collapsed binary")
    runs = F.transform(F.arrays_zip("starts", "lengths", "periods"), lambda r: F.struct(
        r["starts"].alias("start"), r["lengths"].alias("length"), r["periods"].alias("period")))
    return rows.select(F.col("id").cast(kind).alias(id_col), "n_words", runs.alias("runs"), F.col("collapsed").cast("string").alias("collapsed"))
