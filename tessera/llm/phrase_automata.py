"""Substring dedup with repeated-phrase automata (operator 13).

Recurring passages are confirmed by their words, compiled into sharded
Aho-Corasick automata, and every stretch of a document that can hold one is
streamed through its shard's automaton to locate all occurrences. The shard of
a window of words is a function of its words (its seed, the k-gram with the
smallest hash), so that each stretch meets only the automaton that can match.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textblocks import BLOCK_BYTES, Scale, Words, among, block_texts, find_words, listed, recurring, span_hashes, text_blocks

#: Occurrences from which a seed's windows are dealt out one by one.
OFTEN = 1000


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values."""
    n = len(v) - width + 1
    done = 1
    while 2 * done <= width:
        v = np.minimum(v[:-done], v[done:])
        done *= 2
    return np.minimum(v[:n], v[width - done:width - done + n])


def _windows(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, seed's first word, seed's hash) of every window; the seed
    is the leftmost k-gram with the smallest hash, hence a function of the
    window's words."""
    k = (window + 1) // 2
    n = len(words.starts) - window + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),)
    at = np.arange(len(words.starts) - k + 1)
    h = span_hashes(words.hashes, at, at + k)
    low = np.uint64(32)
    seed = _sliding_min((h >> low << low) | at.astype(np.uint64), window - k + 1)
    first = np.flatnonzero(words.doc[:n] == words.doc[window - 1:])
    seed = (seed[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return first, seed, h[seed]


def _stretches(row, window: int, shards: int, scale: Scale) -> dict[int, dict[bytes, list[int]]]:
    """shard -> text -> places of the different stretches of a block whose
    windows have a recurring seed: windows with one seed in common, or single
    windows where the seed occurs very often."""
    words = find_words(block_texts(row))
    first, seed, h = _windows(words, window)
    fp = scale.cut(h)
    keep = among(fp, listed(row.lists))
    first, seed, h, single = first[keep], seed[keep], h[keep], among(fp[keep], listed(row.often))
    found: dict[int, dict[bytes, list[int]]] = {}
    if not len(first):
        return found
    start = np.ones(len(first), bool)
    start[1:] = (np.diff(seed) != 0) | (np.diff(first) != 1) | single[1:]
    a = np.flatnonzero(start)
    b = np.append(a[1:], len(first)) - 1  # first and last window of each stretch
    key = h[a]
    alone = single[a]
    key[alone] = span_hashes(words.hashes, first[a][alone], first[a][alone] + window)
    size = words.ends - words.starts + 1
    ends = np.cumsum(size)
    text = words.spaced()
    for s, x, y, place in zip((key % np.uint64(shards)).tolist(), (ends - size)[first[a]].tolist(),
                              (ends[first[b] + window - 1] - 1).tolist(), first[a].tolist()):
        found.setdefault(s, {}).setdefault(text[x:y], []).append(place)
    return found


def _same_windows(x: np.ndarray, first: np.ndarray, window: int) -> np.ndarray:
    """A number for each window of ``x``, the same for equal windows only."""
    _, like, name = np.unique(span_hashes(x, first, first + window), return_index=True, return_inverse=True)
    rep = first[like[name]]
    if any((x[first + j] != x[rep + j]).any() for j in range(window)):  # a collision
        names: dict[bytes, int] = {}
        name = np.array([names.setdefault(x[i:i + window].tobytes(), len(names)) for i in first.tolist()])
    return name


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the stretches where ``mask`` holds."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _located(texts: list[bytes], copies: np.ndarray, window: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of a shard's different stretches, the word ranges that its
    confirmed passages cover. A passage is a longest row of windows that start
    at two places or more; all of them go into one automaton over word
    numbers, and every stretch is streamed through it."""
    number: dict[bytes, int] = {}
    split = [[number.setdefault(w, len(number)) for w in t.split(b" ")] for t in texts]
    size = np.array([len(s) for s in split])
    x = np.concatenate([np.asarray(s, np.int64) for s in split])
    begin = np.cumsum(size) - size
    of = np.repeat(np.arange(len(texts)), size - window + 1)  # every stretch has a window at least
    place = np.arange(len(of)) - np.repeat(np.cumsum(size - window + 1) - (size - window + 1), size - window + 1)
    first = begin[of] + place
    name = _same_windows(x, first, window)
    confirmed = np.zeros(len(x), bool)
    confirmed[first] = np.bincount(name, copies[of])[name] >= 2
    # a word is a character; shards with more words than there are characters take tuples
    few = len(number) <= 0x110000
    passages = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_STRING if few else ahocorasick.KEY_SEQUENCE)

    def spelled(numbers: list[int]):
        return "".join(map(chr, numbers)) if few else tuple(numbers)

    for a, b in zip(*_runs(confirmed)):  # a stretch's last words start no window: no run crosses stretches
        passages.add_word(spelled(x[a:b - 1 + window].tolist()), int(b - 1 + window - a))
    if not len(passages):
        return [(np.empty(0, np.int64),) * 2] * len(texts)
    passages.make_automaton()
    out = []
    for s in split:
        cover = np.zeros(len(s) + 1, np.int64)
        for end, length in passages.iter(spelled(s)):
            cover[end - length + 1] += 1
            cover[end + 1] -= 1
        out.append(_runs(np.cumsum(cover[:-1]) > 0))
    return out


def remove_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35,
                   fp_bits: int | None = None) -> DataFrame:
    """id_col, n_words, n_removed, kept: every document without the words
    covered by a window of ``window`` consecutive words (2 or more) that also
    starts at another place, of the same document or of any other. All copies
    go, the first one too; windows are judged on the input. ``kept`` has the
    other words, joined by one space. Words are what stands between blanks,
    tabs and line breaks, unchanged.

    Two jobs over the blocks choose what is compared: a window can recur only
    if its seed does. ``fp_bits`` sets the width of the seeds' fingerprints (by
    default it follows the corpus); narrower ones give the same result with
    more work. A shard holds the different stretches of a few megabytes of
    text, each once a block; a seed that occurs ``OFTEN`` times or more has its
    windows dealt out one by one, so that no seed makes a shard large.

    A null or empty text has no words; shorter ones than a window keep all.
    Every row is a document of its own, also one that repeats another's id
    and text (then both lose their windows); a null id stays null; an empty
    table stays empty. Other columns are never read."""
    if window < 2:
        raise ValueError("a window has two words or more")
    kind = docs.schema[id_col].dataType
    blocks = text_blocks(docs, text_col, id_col)
    scale = Scale.of(blocks, 0.2)
    if fp_bits is not None:
        scale.bits = max(fp_bits, scale.range_bits)
    shards = max(8, (blocks.agg(F.sum(F.octet_length("data"))).first()[0] or 0) // BLOCK_BYTES * 4)

    def fingerprints(row) -> np.ndarray:
        words = find_words(block_texts(row))
        _, seed, h = _windows(words, window)
        return h[np.unique(seed, return_index=True)[1]]

    def cut(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in it:
            for row in batch.itertuples():
                rows = []
                for shard, places in _stretches(row, window, shards, scale).items():
                    text = b"\n".join(places)
                    rows.append((shard, len(text), pack(text), row.block,
                                 np.array([len(p) for p in places.values()], np.int32).tobytes(),
                                 np.array([x for p in places.values() for x in p], np.int32).tobytes()))
                if rows:
                    yield pd.DataFrame(rows, columns=["shard", "size", "texts", "block", "copies", "places"])

    def locate(group: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor().decompress
        at: dict[bytes, int] = {}
        of, copies, places = [], [], []
        for row in group.itertuples():
            of.append([at.setdefault(t, len(at)) for t in unpack(row.texts, max_output_size=row.size).split(b"\n")])
            copies.append(np.frombuffer(row.copies, np.int32))
            places.append(np.frombuffer(row.places, np.int32).astype(np.int64))
        ranges = _located(list(at), np.bincount(np.concatenate(of), np.concatenate(copies)), window)
        spans = []
        for texts, n, all_places in zip(of, copies, places):
            parts = np.split(all_places, np.cumsum(n)[:-1])
            spans.append(b"".join(np.stack([(p[:, None] + ranges[k][0]).ravel(), (p[:, None] + ranges[k][1]).ravel()]).T
                                  .astype(np.int32).tobytes() for k, p in zip(texts, parts)))
        out = pd.DataFrame({"block": group["block"], "spans": spans})
        return out[out["spans"].str.len() > 0]

    def removed(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in it:
            for row in batch.itertuples():
                words = find_words(block_texts(row))
                cover = np.zeros(len(words.starts) + 1, np.int64)
                if row.spans is not None:
                    spans = np.frombuffer(b"".join(row.spans), np.int32).reshape(-1, 2)
                    np.add.at(cover, spans[:, 0], 1)
                    np.add.at(cover, spans[:, 1], -1)
                keep = np.cumsum(cover[:-1]) == 0
                n = words.per_doc()
                yield pd.DataFrame({"id": row.ids, "n_words": n,
                                    "n_removed": n - np.bincount(words.doc[keep], minlength=words.n_docs),
                                    "kept": words.joined(keep)})

    data = blocks.select("block", "sizes", "data")
    lists = recurring(data, fingerprints, 2, scale, OFTEN)
    stretches = data.join(lists, "block").mapInPandas(
        cut, "shard long, size int, texts binary, block long, copies binary, places binary")
    spans = (stretches.groupBy("shard").applyInPandas(locate, "block long, spans binary")
             .groupBy("block").agg(F.collect_list("spans").alias("spans")))
    out = blocks.join(spans, "block", "left").mapInPandas(
        removed, "id string, n_words long, n_removed long, kept binary")
    return out.select(F.col("id").cast(kind).alias(id_col), "n_words", "n_removed",
                      F.col("kept").cast("string").alias("kept"))
