"""Benchmark decontamination by greedy string tiling (operator 2)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tessera.session import materialize

from .common import word_hashes

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEPARATOR = np.uint64(0)  # the hash of no word
_TOKEN = re.compile(r"\w+")


def tokens_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return _TOKEN.findall(text.lower()) if text else []


def _window_hashes(x: np.ndarray, s: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``s`` tokens (modulo 2^64), by
    doubling: a window of 2k is two windows of k."""
    out, have = None, 0
    part, k = x, 1
    while True:
        if s & k:
            if out is None:
                out, have = part, k
            else:
                m = len(x) - have - k + 1
                out = part[:m] * np.uint64(pow(int(_BASE), have, 1 << 64)) + out[k:k + m] if m > 0 else out[:0]
                have += k
        if k * 2 > s:
            return out
        m = len(x) - 2 * k + 1
        part = part[:m] * np.uint64(pow(int(_BASE), k, 1 << 64)) + part[k:k + m] if m > 0 else part[:0]
        k *= 2


def tiles(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two token arrays: (doc start, item start,
    length) of matches of at least ``least`` tokens, no token in two of them,
    longest first (ties: earliest in the item, then in the document).

    Running Karp-Rabin: windows of the search length that hold no marked token
    are hashed and matched; matches are extended and marked from the longest
    on; then the search length falls towards ``least``.
    """
    if least < 1:
        raise ValueError("least must be positive")
    dead_d, dead_i = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    out, s = [], min(len(doc), len(item))
    while s >= least:
        found = _matches(doc, item, dead_d, dead_i, s)
        longest = max((n for *_, n in found), default=0)
        if longest > 2 * s:
            s = longest
            continue
        for n, i, d in sorted(((n, i, d) for d, i, n in found), key=lambda m: (-m[0], m[1], m[2])):
            if not dead_d[d:d + n].any() and not dead_i[i:i + n].any():
                out.append((d, i, n))
                dead_d[d:d + n] = dead_i[i:i + n] = True
        # what a mark has cut short is found again, longest first, before shorter ones
        rest = max((n for *_, n in _matches(doc, item, dead_d, dead_i, least)), default=0)
        s = min(s, rest) if rest >= least else 0
    return out


def _matches(doc, item, dead_d, dead_i, s) -> list[tuple[int, int, int]]:
    """Maximal matches of at least ``s`` unmarked tokens."""
    hd, hi = _window_hashes(doc, s), _window_hashes(item, s)
    free_d = np.flatnonzero(np.convolve(dead_d, np.ones(s, int), "valid") == 0)
    free_i = np.flatnonzero(np.convolve(dead_i, np.ones(s, int), "valid") == 0)
    if not len(free_d) or not len(free_i):
        return []
    by: dict[int, list[int]] = {}
    for i in free_i.tolist():
        by.setdefault(int(hi[i]), []).append(i)
    hits = free_d[np.isin(hd[free_d], hi[free_i])]
    out = []
    for d in hits.tolist():
        for i in by.get(int(hd[d]), ()):
            if d and i and doc[d - 1] == item[i - 1] and not dead_d[d - 1] and not dead_i[i - 1]:
                continue  # part of a match that starts earlier
            n = 0
            while (d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n]
                   and not dead_d[d + n] and not dead_i[i + n]):
                n += 1
            if n >= s:
                out.append((d, i, n))
    return out


class Seeds:
    """Token n-grams of a block of benchmark items, for the join with the
    documents' n-grams."""

    def __init__(self, items: list[tuple[int, list[str]]], least: int):
        self.least = least
        self.items = [(k, word_hashes(t)) for k, t in items if t]
        self.short = {}  # items below `least` tokens: all their tokens are one seed
        grams, owner = [], []
        for n, (_, x) in enumerate(self.items):
            m = min(least, len(x))
            h = _window_hashes(x, m)
            if m < least:
                self.short.setdefault(m, []).append(n)
            else:
                grams.append(h)
                owner.append(np.full(len(h), n))
        g = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        o = np.concatenate(owner) if owner else np.empty(0, np.int64)
        order = np.argsort(g, kind="stable")
        self.grams, self.owner = g[order], o[order]
        self.distinct = np.unique(self.grams)

    def coverage(self, doc: np.ndarray) -> list[tuple[int, int, int]]:
        """(item number, matched tokens, item tokens) of the items that share a seed with the document."""
        out = []
        if len(self.distinct) and len(doc) >= self.least:
            h = _window_hashes(doc, self.least)
            at = np.searchsorted(self.distinct, h)
            at[at == len(self.distinct)] = 0
            places = np.flatnonzero(self.distinct[at] == h)
            if len(places):
                lo = np.searchsorted(self.grams, h[places], "left")
                hi = np.searchsorted(self.grams, h[places], "right")
                pairs = np.unique(np.stack([np.concatenate([self.owner[a:b] for a, b in zip(lo, hi)]),
                                            np.repeat(places, hi - lo)], 1), axis=0)
                for n in np.unique(pairs[:, 0]):
                    x = self.items[n][1]
                    mine = pairs[pairs[:, 0] == n, 1]
                    # tiles lie inside the runs of tokens that seeds cover; a
                    # separator token of no item keeps the runs apart
                    runs = np.split(mine, np.flatnonzero(np.diff(mine) > self.least) + 1)
                    parts = []
                    for r in runs:
                        parts += [doc[r[0]:r[-1] + self.least], np.array([_SEPARATOR], np.uint64)]
                    got = sum(t[2] for t in tiles(np.concatenate(parts), x, self.least))
                    out.append((int(n), got, len(x)))
        for m, numbers in self.short.items():
            if len(doc) >= m:
                here = set(_window_hashes(doc, m).tolist())
                out += [(n, m, m) for n in numbers if int(_window_hashes(self.items[n][1], m)[0]) in here]
        return out


def benchmark_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int):
    """How many blocks of about ``block_chars`` characters the benchmark
    makes, and a function that brings one of them to the driver."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = -(-total // block_chars)

    def block(k: int) -> list[tuple]:
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        return [(r["item"], tokens_of(r["text"])) for r in part.collect()]
    return blocks, block


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", least_match: int = 5,
                  coverage: float = 0.8, block_chars: int = 8_000_000) -> DataFrame:
    """How much of a benchmark item each document contains, in any order.

    Documents and items are joined on shared runs of ``least_match`` tokens;
    each such pair is tiled, and the item's coverage is the share of its
    tokens in tiles. The benchmark goes to the tasks in blocks of bounded
    size, a pass over the documents for each, so it may be of any size.

    One row per document row: ``id_col``, coverage (greatest over all items;
    0 without any match), item_id (the item with it, the smallest on ties;
    null without match), n_items (items covered to ``coverage`` or more),
    contaminated. Null and empty texts match nothing; items without a token
    are never matched, items shorter than ``least_match`` only as a whole.
    Repeated rows and null ids are kept; an empty table gives no rows; other
    columns are ignored.
    """
    item_field = benchmark.schema[item_col].dataType
    item_type = to_arrow_type(item_field)
    state = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                        F.lit(0.0).alias("coverage"), F.lit(None).cast(item_field).alias("item_id"),
                        F.lit(0).cast("long").alias("n_items"))
    blocks, items = benchmark_blocks(benchmark, item_col, item_text_col, block_chars)
    for k in range(blocks):
        state = state.mapInArrow(_scan(items(k), least_match, coverage, item_type), state.schema)
        if blocks > 1:
            state = materialize(state, "decontaminate")
    return state.select(F.col("id").alias(id_col), "coverage", "item_id", "n_items",
                        (F.col("n_items") > 0).alias("contaminated"))


def _scan(items: list[tuple], least_match: int, coverage: float, item_type: pa.DataType):
    """One pass over the documents for one block of items, carrying the best
    item so far along."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        seeds = Seeds(items, least_match)
        for b in batches:
            rows = []
            for text, *best, many in zip(*[b.column(k).to_pylist() for k in range(1, 5)]):
                hits = [(got / size, seeds.items[n][0]) for n, got, size in seeds.coverage(word_hashes(tokens_of(text)))]
                if best[0] > 0:
                    hits.append(tuple(best))
                    many -= best[0] >= coverage  # counted again below
                top = min(hits, key=lambda h: (-h[0], h[1] is None, h[1]), default=(0.0, None))
                rows.append((*top, many + sum(h[0] >= coverage for h in hits)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([r[0] for r in rows], pa.float64()),
                 pa.array([r[1] for r in rows], item_type), pa.array([r[2] for r in rows], pa.int64())],
                names=["id", "text", "coverage", "item_id", "n_items"])
    return run


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated. Rows that repeat an id
    go together; rows without an id stay only if no row without one is
    contaminated."""
    bad = (decontaminate(docs, benchmark, id_col, text_col, **options).where("contaminated")
           .select(F.col(id_col).alias("_bad")).distinct())
    return docs.join(bad, docs[id_col].eqNullSafe(bad["_bad"]), "left_anti")
