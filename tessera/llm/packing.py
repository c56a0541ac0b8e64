"""Packing documents into sequences by bin completion (operator 6).

Only the lengths below the capacity are a packing problem, and there are at
most ``capacity - 1`` different ones. So the search runs over the histogram of
lengths, whose size does not grow with the corpus, and its result is a list of
patterns (a filling and how often it is used). Spark counts the histogram,
numbers the pieces by length with one distributed sort of narrow rows, and
looks up each piece's place by that number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import global_row_number
from tessera.session import materialize

from .tokens import default_path, encoder

Pattern = tuple[tuple[int, ...], int]


def lower_bound(hist: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: by total length, and by pieces that
    exclude each other (two of more than half the capacity never share)."""
    total = sum(n * c for n, c in hist.items())
    return max(-(-total // capacity), sum(c for n, c in hist.items() if 2 * n > capacity))


def best_fit(hist: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing over the histogram: equal pieces go together into
    the open bins with the least sufficient room."""
    rooms: dict[int, list[list]] = {}  # room -> [items, bins with them]
    for n in sorted(hist, reverse=True):
        left = hist[n]
        while left:
            room = next((r for r in range(n, capacity) if rooms.get(r)), None)
            if room is None:
                per = capacity // n
                whole, rest = divmod(left, per)
                for items, bins in (((n,) * per, whole), ((n,) * rest, 1 if rest else 0)):
                    if bins:
                        rooms.setdefault(capacity - n * len(items), []).append([items, bins])
                break
            items, bins = rooms[room].pop()
            take = min(bins, left)
            rooms.setdefault(room - n, []).append([items + (n,), take])
            if bins > take:
                rooms[room].append([items, bins - take])
            left -= take
    return [(tuple(items), bins) for group in rooms.values() for items, bins in group]


def completions(counts: np.ndarray, room: int, keep: int, effort: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` with the available lengths, least
    waste first. A filling is dominated when another piece would still fit
    into it, or when a single piece could replace some of its pieces with no
    more waste; depth-first from the largest piece finds the dominating ones
    first. Stops at a filling without waste or after ``effort`` steps."""
    lengths = np.flatnonzero(counts)
    if not len(lengths) or lengths[0] > room:
        return [()]
    smallest = int(lengths[0])
    found: dict[int, tuple[int, ...]] = {}
    left = counts.copy()
    steps = 0

    def search(room: int, largest: int, chosen: list[int]) -> bool:
        nonlocal steps
        steps += 1
        if room <= largest and room > 0 and left[room] > 0:  # exact end
            found[0] = (*chosen, room)
            return True
        if room < smallest or steps > effort:
            found.setdefault(room, tuple(chosen))
            return steps > effort
        k = np.searchsorted(lengths, min(room, largest), side="right") - 1
        fits = False
        for n in lengths[k::-1] if k >= 0 else ():
            n = int(n)
            if not left[n]:
                continue
            fits = True
            left[n] -= 1
            chosen.append(n)
            done = search(room - n, n, chosen)
            chosen.pop()
            left[n] += 1
            if done:
                return True
            # what is filled with pieces of at most n wastes no less than this bound
            if found and min(found) == 0:
                return True
        if not fits:
            # a larger piece than `largest` may still fit: then dominated
            k = np.searchsorted(lengths, room, side="right") - 1
            if not any(left[int(n)] for n in lengths[:k + 1]):
                found.setdefault(room, tuple(chosen))
        return False

    search(room, room, [])
    return [found[w] for w in sorted(found)][:keep] or [()]


def bin_completion(hist: dict[int, int], capacity: int, keep: int = 3, effort: int = 3000,
                   nodes: int = 20_000) -> tuple[list[Pattern], bool]:
    """Patterns that pack the histogram, and whether they are proven optimal.

    The incumbent is best-fit. Each node takes the largest open piece, tries
    its undominated completions (least waste first) and uses the completion
    for as many bins as the counts allow; a branch is cut when its waste so
    far cannot beat the incumbent. ``keep``, ``effort`` and ``nodes`` bound
    the search only: every piece is always packed.
    """
    hist = {int(n): int(c) for n, c in hist.items() if c}
    if not hist:
        return [], True
    bound = lower_bound(hist, capacity)
    best = best_fit(hist, capacity)
    best_bins = sum(b for _, b in best)
    total = sum(n * c for n, c in hist.items())
    if best_bins == bound:
        return best, True
    counts = np.zeros(capacity + 1, np.int64)
    for n, c in hist.items():
        counts[n] = c
    spent = 0
    # depth-first with an explicit stack: (counts, patterns, bins, waste)
    stack = [(counts, [], 0, 0)]
    while stack and spent < nodes and best_bins > bound:
        counts, patterns, bins, waste = stack.pop()
        spent += 1
        open_lengths = np.flatnonzero(counts)
        if not len(open_lengths):
            if bins < best_bins:
                best, best_bins = patterns, bins
            continue
        # bins of the finished packing = (total + waste) / capacity
        if -(-(total + waste) // capacity) >= best_bins:
            continue
        largest = int(open_lengths[-1])
        rest = counts.copy()
        rest[largest] -= 1
        children = []
        for filling in completions(rest, capacity - largest, keep, effort):
            items = (largest, *filling)
            uses = {n: items.count(n) for n in set(items)}
            times = min(int(counts[n]) // u for n, u in uses.items())
            after = counts.copy()
            for n, u in uses.items():
                after[n] -= u * times
            children.append((after, [*patterns, (items, times)], bins + times,
                             waste + times * (capacity - sum(items))))
        stack.extend(reversed(children))
    return best, best_bins == bound


def _pieces(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    enc, uid = encoder(path), TaskContext.get().partitionId() << 36
    end = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            rows, piece, start, length, ids, crc = [], [], [], [], [], []
            for row, text in enumerate(part.column(1).to_pylist()):
                data = enc.ids(text or "") + end
                n = len(data) // 4
                first = n % capacity or capacity
                at = 0
                for k in range(-(-n // capacity)):
                    size = first if k == 0 else capacity
                    chunk = data[4 * at:4 * (at + size)]
                    rows.append(row)
                    piece.append(k)
                    start.append(at)
                    length.append(size)
                    ids.append(chunk)
                    crc.append(zlib.crc32(chunk))
                    at += size
            n = len(rows)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(rows, pa.int32())), pa.array(range(uid, uid + n), pa.int64()),
                 pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(crc, pa.int64())],
                names=["id", "uid", "piece", "start", "length", "ids", "ids_crc32"])
            uid += n


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer_path: str | None = None, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """The token ids of each text plus ``end_id``, cut into pieces of at most
    ``capacity``: only texts longer than it are cut, the remainder comes
    first. Columns id, uid (unique), piece, start, length, ids (little-endian
    uint32), ids_crc32. Null text: empty, one piece that holds ``end_id``."""
    path = tokenizer_path or default_path()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(lambda it: _pieces(it, path, end_id, capacity),
                          f"id {kind}, uid long, piece int, start long, length long, ids binary, ids_crc32 long")


def place(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """``uid, length`` -> ``uid, sequence_id, offset, proven``. Pieces of the full
    capacity get a (negative) sequence each; the others are packed. ``proven``
    says whether the number of sequences is known to be the least."""
    full = (pieces.where(F.col("length") >= capacity)
            .select("uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    short = pieces.where(F.col("length") < capacity).select("uid", "length")
    hist = {r["length"]: r["n"] for r in short.groupBy("length").agg(F.count("*").alias("n")).collect()}
    patterns, proven = bin_completion(hist, capacity)
    # places of each length in order: (count, first sequence, uses per sequence, offset)
    by_length: dict[int, list[tuple[int, int, int, int]]] = {}
    seq = 0
    for items, times in patterns:
        at = 0
        for n in sorted(set(items), reverse=True):
            u = items.count(n)
            by_length.setdefault(n, []).append((u * times, seq, u, at))
            at += u * n
        seq += times
    slots = [(c, s, u, o, n) for n in sorted(by_length) for c, s, u, o in by_length[n]]
    table = np.array(slots, np.int64).reshape(-1, 5)
    starts = np.cumsum(table[:, 0]) - table[:, 0]

    def look_up(batches):
        for b in batches:
            g = b.column(1).to_numpy()
            k = np.searchsorted(starts, g, side="right") - 1
            nth = g - starts[k]
            u = table[k, 2]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(table[k, 1] + nth // u), pa.array(table[k, 3] + nth % u * table[k, 4])],
                names=["uid", "sequence_id", "offset"])

    if not slots:
        return full.withColumn("proven", F.lit(proven))
    numbered = global_row_number(short, [F.col("length"), F.col("uid")], out="g", start=0)
    return full.unionByName(numbered.select("uid", "g").mapInArrow(
        look_up, "uid long, sequence_id long, offset long")).withColumn("proven", F.lit(proven))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   tokenizer_path: str | None = None, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` tokens.

    One row per piece: ``id_col``, piece, start, length, ids (little-endian
    uint32 token ids), ids_crc32, sequence_id, offset, proven (whether the number
    of sequences is known to be the least). The pieces are written
    once to the shared folder and read back; narrow rows alone are sorted.

    Nulls: a null text counts as empty, a null id is kept. Repeated rows are
    packed as often as they occur. An empty table gives no rows. Other
    columns are ignored, whatever their names.
    """
    pieces = materialize(token_pieces(docs, id_col, text_col, tokenizer_path, end_id, capacity), "pieces")
    placed = place(pieces.select("uid", "length"), capacity)
    return (pieces.join(placed, "uid")
            .select(F.col("id").alias(id_col), "piece", "start", "length", "ids", "ids_crc32",
                    "sequence_id", "offset", "proven"))
