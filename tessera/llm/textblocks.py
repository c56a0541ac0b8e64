"""Texts in blocks, their words as numpy spans, and a distributed count of
fingerprints (shared by operators 11 to 13).

A block is one row that holds the UTF-8 bytes of some whole documents. Words
are found in a block with array operations; a prefix polynomial over the bytes
gives the hash of any span. ``recurring`` counts fingerprints over all blocks
and sends each block back the list of its own frequent ones: no list of all of
them is ever broadcast or collected.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

from .common import mix, small_batches

#: Bytes of text after which a block is closed (a longer document is a block of its own).
BLOCK_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def _classes(separators: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(separators)] = True
    return table


#: Bytes between words: [\x20\x09-\x0D].
WHITE = _classes(b" \t\n\x0b\x0c\r")

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n - 1) modulo 2**64, remembered up to twice a block."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(1 << n.bit_length(), base, np.uint64)
        have[:1] = 1
        have = np.multiply.accumulate(have)
        if n <= 2 * BLOCK_BYTES:
            _powers[base] = have
    return have[:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span [start, end) of ``values`` from one prefix polynomial
    (Rabin-Karp): equal spans have equal hashes wherever they stand."""
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(values)), out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * _power(_INVERSE, len(values) + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64))


@dataclass
class Words:
    """The words of some documents, in order: byte spans in ``buf``, number
    of the document, hash. ``doc_starts`` has one more entry at the end."""

    buf: np.ndarray
    doc_starts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    hashes: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.doc_starts) - 1

    def per_doc(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)

    def word(self, k: int) -> bytes:
        return self.buf[self.starts[k]:self.ends[k]].tobytes()

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """(class of each word, first word of each class): equal words, and
        only they, share a class. Hashes group the words; then each word's
        bytes are compared with those of its class."""
        _, first, of = np.unique(self.hashes, return_index=True, return_inverse=True)
        size = self.ends - self.starts
        like = first[of]
        same = bool((size == size[like]).all())
        if same and len(size):
            before = np.cumsum(size) - size
            at = np.arange(int(size.sum()))
            same = bool((self.buf[at + np.repeat(self.starts - before, size)]
                         == self.buf[at + np.repeat(self.starts[like] - before, size)]).all())
        if not same:  # a collision: name the words by their bytes
            names: dict[bytes, int] = {}
            of = np.fromiter((names.setdefault(self.word(k), len(names)) for k in range(len(size))), np.int64, len(size))
            _, first = np.unique(of, return_index=True)
        return of, first

    def spaced(self, keep=slice(None)) -> bytes:
        """The kept words of all documents, each with one space after it."""
        ends = self.ends[keep]
        buf = np.append(self.buf, np.uint8(32))
        buf[ends] = 32
        edge = np.zeros(len(buf) + 1, np.int8)
        edge[self.starts[keep]] = 1
        edge[ends + 1] -= 1
        return buf[np.cumsum(edge[:-1], dtype=np.int8) > 0].tobytes()

    def joined(self, keep: np.ndarray) -> list[bytes]:
        """Each document's kept words, joined by one space."""
        out = self.spaced(keep)
        size = np.bincount(self.doc[keep], self.ends[keep] - self.starts[keep] + 1, self.n_docs).astype(np.int64)
        stop = np.cumsum(size)
        return [out[b - n:b - 1] if n else b"" for b, n in zip(stop.tolist(), size.tolist())]


def find_words(texts: list[bytes], separators: np.ndarray = WHITE) -> Words:
    """The words between separator bytes; documents are put together with a
    line feed, which has to be a separator."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    doc_starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])
    inside = np.zeros(len(buf) + 1, np.int8)
    inside[1:] = ~separators[buf]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return Words(buf, doc_starts, starts, ends, np.searchsorted(doc_starts, starts, side="right") - 1,
                 span_hashes(buf, starts, ends))


# --- blocks -----------------------------------------------------------------
def _blocks(batches: Iterator[pd.DataFrame], block_bytes: int, lower: bool) -> Iterator[pd.DataFrame]:
    """Rows (block_key, ids, sizes, data); a document without a text is empty."""
    pack = zstandard.ZstdCompressor(level=1).compress
    held: dict[object, tuple[list, list]] = {}
    n: dict[object, int] = {}

    def row(key) -> pd.DataFrame:
        ids, texts = held.pop(key)
        n.pop(key)
        return pd.DataFrame({"block_key": [key], "ids": [ids], "sizes": [[len(t) for t in texts]],
                             "data": [pack(b"".join(texts))]})

    for batch in batches:
        for key, at, text in zip(batch["block_key"], batch["id"], batch["text"]):
            text = text or b""
            ids, texts = held.setdefault(key, ([], []))
            ids.append(at)
            texts.append(text.lower() if lower else text)  # of bytes: A-Z only
            n[key] = n.get(key, 0) + len(text) + 8
            if n[key] >= block_bytes:
                yield row(key)
        while sum(n.values()) > 16 * block_bytes:  # many keys: the largest goes
            yield row(max(n, key=n.__getitem__))
    for key in list(held):
        yield row(key)


def text_blocks(docs: DataFrame, text_col: str, id_col: str | None = None, key=None, lower: bool = False,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents in blocks, written once: block (number), block_key (a
    string; documents of one key share a block), ids (as strings), sizes, data.
    Every row is in one block, also one with a null id or text."""
    src = docs.select((F.lit(None) if id_col is None else F.col(id_col)).cast("string").alias("id"),
                      F.col(text_col).cast("string").cast("binary").alias("text"),
                      (F.lit("") if key is None else key).cast("string").alias("block_key"))
    with small_batches(docs.sparkSession, 256):
        out = src.mapInPandas(lambda it: _blocks(it, block_bytes, lower),
                              "block_key string, ids array<string>, sizes array<int>, data binary")
        return materialize(out.withColumn("block", F.monotonically_increasing_id()), "blocks")


def block_texts(row) -> list[bytes]:
    """The documents of a block row, in order."""
    data = zstandard.ZstdDecompressor().decompress(row.data, max_output_size=max(1, int(sum(row.sizes))))
    ends = np.cumsum(np.asarray(row.sizes, np.int64)).tolist()
    return [data[b - int(n):b] for b, n in zip(ends, row.sizes)]


# --- fingerprints -----------------------------------------------------------
@dataclass
class Scale:
    """How fingerprints are cut and dealt: ``bits`` of each are kept and their
    upper ``range_bits`` number the range that counts them."""

    bits: int
    range_bits: int

    @staticmethod
    def of(blocks: DataFrame, per_byte: float) -> Scale:
        """For blocks that give at most ``per_byte`` fingerprints a byte: so
        many bits that a chance meeting is rare, about 8 million a range.
        More meetings would cost time, not right results."""
        n = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
        most = max(n * per_byte, 1)
        return Scale(min(64, 14 + math.ceil(math.log2(most + 1))), max(4, math.ceil(math.log2(most / 8e6 + 1))))

    def cut(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> np.uint64(64 - self.bits)


def _pack(sorted_fps: np.ndarray, base: int) -> bytes:
    """Sorted fingerprints as differences, byte plane by byte plane."""
    steps = np.diff(sorted_fps, prepend=np.uint64(base))
    wide = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return steps.view(np.uint8).reshape(-1, 8)[:, :wide].T.tobytes()


def _unpack(data: bytes, n: int, base: int) -> np.ndarray:
    steps = np.zeros((n, 8), np.uint8)
    steps[:, :len(data) // n] = np.frombuffer(data, np.uint8).reshape(-1, n).T
    return np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64) + np.uint64(base)


def recurring(blocks: DataFrame, fingerprints: Callable, least: int, scale: Scale,
              often: int = 1 << 62) -> DataFrame:
    """block, lists, often: the fingerprints of each block that occur ``least``
    times or more (at most 255) in all blocks together, and those counted
    ``often`` times, as arrays of packed 64-bit values.

    ``fingerprints(row)`` gives all of a block's. A block sends its distinct
    ones, sorted and packed, with counts up to 255 to the ranges; a range sums
    them and answers each block with those that reach the bounds. What stands
    for an occurrence is thus its block and its place in the block's list. A
    fingerprint reaches its range at most once a block, whatever its copies.
    """
    shift = np.uint64(scale.bits - scale.range_bits)

    def sent(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in it:
            for row in batch.itertuples():
                fps, n = np.unique(scale.cut(fingerprints(row)), return_counts=True)
                if not len(fps):
                    continue
                n = np.minimum(n, 255).astype(np.uint8)
                ranges = (fps >> shift).astype(np.int64)
                at = np.flatnonzero(np.diff(ranges, prepend=-1))
                ends = np.append(at[1:], len(fps))
                yield pd.DataFrame({
                    "range": ranges[at], "block": row.block,
                    "fps": [_pack(fps[a:b], int(ranges[a]) << int(shift)) for a, b in zip(at, ends)],
                    "counts": [n[a:b].tobytes() for a, b in zip(at, ends)]})

    def counted(group: pd.DataFrame) -> pd.DataFrame:
        base = int(group["range"].iloc[0]) << int(shift)
        size = [len(c) for c in group["counts"]]
        fps = np.concatenate([_unpack(f, n, base) for f, n in zip(group["fps"], size)])
        n = np.frombuffer(b"".join(group["counts"]), np.uint8)
        order = np.argsort(fps, kind="stable")
        first = np.flatnonzero(np.diff(fps[order], prepend=fps[order[:1]] + np.uint64(1)))
        total = np.zeros(len(fps), np.int64)
        total[order] = np.repeat(np.add.reduceat(n[order].astype(np.int64), first), np.diff(np.append(first, len(fps))))
        stop = np.cumsum(size)
        parts = [(fps[b - m:b], total[b - m:b]) for b, m in zip(stop, size)]
        out = pd.DataFrame({"block": group["block"], "fps": [f[t >= least].tobytes() for f, t in parts],
                            "often": [f[t >= often].tobytes() for f, t in parts]})
        return out[out["fps"].str.len() > 0]

    rows = blocks.mapInPandas(sent, "range long, block long, fps binary, counts binary")
    lists = rows.groupBy("range").applyInPandas(counted, "block long, fps binary, often binary")
    return lists.groupBy("block").agg(F.collect_list("fps").alias("lists"), F.collect_list("often").alias("often"))


def listed(lists) -> np.ndarray:
    """The sorted fingerprints of one of the columns that ``recurring`` gives."""
    if lists is None or not len(lists):
        return np.empty(0, np.uint64)
    return np.sort(np.frombuffer(b"".join(lists), np.uint64))


def among(fps: np.ndarray, listed_fps: np.ndarray) -> np.ndarray:
    """Whether each fingerprint is one of the sorted list."""
    if not len(listed_fps):
        return np.zeros(len(fps), bool)
    at = np.minimum(np.searchsorted(listed_fps, fps), len(listed_fps) - 1)
    return listed_fps[at] == fps
