"""Toxicity by a weighted lexicon (operator 8): texts are folded (homoglyphs,
digits for letters), matched with Aho-Corasick, exception phrases cancel the
matches inside them, and the sum of weights is normalised by length."""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

# Letters of other scripts that look like Latin ones, and signs written for letters.
HOMOGLYPHS = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "к": "k", "м": "m", "н": "h",
              "т": "t", "в": "b", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ɡ": "g", "ӏ": "l", "ո": "n",
              "α": "a", "ε": "e", "ο": "o", "ρ": "p", "υ": "u", "χ": "x", "ι": "i", "κ": "k", "ν": "v", "τ": "t",
              "ı": "i", "ⅼ": "l", "ℓ": "l"}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
INVISIBLE = "­​‌‍⁠﻿"

_SIGN = re.compile(r"[0-9@$]")
_LONE = re.compile(r"(?<![^\W\d_]|[0-9@$])[0-9@$]+(?![^\W\d_]|[0-9@$])")  # whole runs, no letter at either side
_COMPATIBLE = re.compile("[̀-ͯᴀ-ᶿ℀-⅏①-⓿＀-￯\U0001d400-\U0001d7ff]")
_TABLE = {**{ord(a): b for a, b in HOMOGLYPHS.items()}, **{ord(a): b for a, b in SIGNS.items()},
          **{ord(c): None for c in INVISIBLE},
          **{c: " " for c in range(128) if not chr(c).isalnum() and chr(c) not in "@$"},
          **{ord(c): " " for c in " ¡¿«»“”„‘’‚–—…·•  　"}}


def fold(text: str | None) -> str:
    """Lower case, one form for look-alike letters, signs inside words read as
    letters, numbers dropped, words separated by single spaces, with a space
    at both ends."""
    if not text:
        return " "
    text = text.lower()
    if not text.isascii() and _COMPATIBLE.search(text):
        text = unicodedata.normalize("NFKC", text).lower()
    if _SIGN.search(text):
        text = _LONE.sub(" ", text)
    words = text.translate(_TABLE).split()
    return f" {' '.join(words)} " if words else " "


def stems(words: set[str], shortest: int = 4, longest: int = 10) -> set[str]:
    """Candidate entries of a text: " stem" for the beginnings of its words
    and " word " for words shorter than ``shortest``."""
    out = set()
    for w in words:
        if len(w) < shortest:
            out.add(f" {w} ")
        else:
            out.update(f" {w[:k]}" for k in range(shortest, min(longest, len(w)) + 1))
    return out


@dataclass
class Lexicon:
    """``weights``: entry (" stem" or " word ") -> weight. ``exceptions``:
    phrases (" word word ") inside which entries do not count. The score is
    the logistic function of slope * log1p(weight per 100 words) + offset."""

    weights: dict[str, float]
    exceptions: set[str] = field(default_factory=set)
    slope: float = 1.0
    offset: float = -3.0

    def __post_init__(self):
        self._machine = None

    def __getstate__(self):
        return self.__dict__ | {"_machine": None}

    def machine(self):
        if self._machine is None:
            import ahocorasick
            m = ahocorasick.Automaton()
            for e in self.exceptions:
                m.add_word(e, (e, None))
            for e, w in self.weights.items():
                if e not in self.exceptions:
                    m.add_word(e, (e, w))
            if len(m):
                m.make_automaton()
            self._machine = m
        return self._machine

    def matches(self, folded: str) -> list[tuple[int, str, float]]:
        """(start, entry, weight): at each word start the longest entry,
        unless an exception phrase covers its place."""
        if not len(self.machine()):
            return []
        best: dict[int, tuple[str, float]] = {}
        covered: list[tuple[int, int]] = []
        for end, (e, w) in self.machine().iter(folded):
            start = end - len(e) + 1
            if w is None:
                covered.append((start, end))
            elif start not in best or len(e) > len(best[start][0]):
                best[start] = (e, w)
        covered.sort()
        starts = [a for a, _ in covered]
        reach = list(accumulate((b for _, b in covered), max))  # of the spans up to here, the furthest end
        out = []
        for s, (e, w) in sorted(best.items()):
            k = bisect_right(starts, s)
            if not k or reach[k - 1] < s + len(e.rstrip()) - 1:
                out.append((s, e, w))
        return out

    def density(self, folded: str) -> float:
        """Matched weight per 100 words (short texts count as 20 words)."""
        return 100 * sum(w for _, _, w in self.matches(folded)) / max(20, folded.count(" ") - 1)

    def score(self, text: str | None) -> float:
        z = self.slope * math.log1p(max(0.0, self.density(fold(text)))) + self.offset
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def _count_stems(batches) -> Iterator[pa.RecordBatch]:
    tallies = (Counter(), Counter())
    for b in batches:
        for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            tallies[y].update(stems(set(fold(t).split())))
    for y in (0, 1):
        items = list(tallies[y].items())
        for lo in range(0, len(items), 50_000):
            part = items[lo:lo + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([e for e, _ in part]), pa.array([n * (1 - y) for _, n in part], pa.int64()),
                 pa.array([n * y for _, n in part], pa.int64())], names=["entry", "clean", "toxic"])


def choose_entries(rows: list[tuple[str, int, int]], clean: int, toxic: int, least_weight: float) -> dict[str, float]:
    """Weights of the entries worth keeping: log odds of at least
    ``least_weight``; of nested stems the longest that loses little support,
    and nothing longer than a kept stem."""
    weight = {e: math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1)) for e, c, t in rows}
    support = {e: t for e, c, t in rows}
    good = {e for e, w in weight.items() if w >= least_weight}
    longer: dict[str, int] = {}
    for e in good:
        if len(e) > 2 and not e.endswith(" "):
            longer[e[:-1]] = max(longer.get(e[:-1], 0), support[e])
    kept: dict[str, float] = {}
    for e in sorted(good, key=lambda e: (len(e), e)):
        if longer.get(e, 0) >= 0.8 * support[e]:
            continue  # a longer stem has nearly the same support
        if any(e[:k] in kept for k in range(2, len(e))):
            continue
        kept[e] = weight[e]
    return kept


def learn_lexicon(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic", sample_toxic: int = 4000, sample_clean: int = 16_000,
                  least_support: int = 8, least_weight: float = 2.5, seed: int = 13) -> Lexicon:
    """Fit on labelled rows where ``learn`` (an expression of the id) holds.

    About ``sample_toxic`` and ``sample_clean`` rows at most are used, chosen
    by a seeded hash of the id (the documented bound of the fit); of these the
    whole texts. Entries are counted in tasks and summed by Spark; only
    entries with at least ``least_support`` toxic texts reach the driver.
    """
    named = (labels.where(learn).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
             .where("id is not null and y in (0, 1)"))
    named = named.groupBy("id").agg(F.max("y").alias("y"))
    n = {r["y"]: r["n"] for r in named.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = {1: min(1.0, sample_toxic / max(1, n.get(1, 0))), 0: min(1.0, sample_clean / max(1, n.get(0, 0)))}
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(seed)), F.lit(1 << 30))
    picked = named.where(draw < F.when(F.col("y") == 1, int(share[1] * (1 << 30))).otherwise(int(share[0] * (1 << 30))))
    # bounded by the sample sizes above
    picked = F.broadcast(picked)
    sample = materialize(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
                         .join(picked, "id").select("text", "y"), "labelled")
    total = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    clean, toxic = total.get(0, 0), total.get(1, 0)
    if not toxic:
        return Lexicon({})
    found = (sample.mapInArrow(_count_stems, "entry string, clean long, toxic long").groupBy("entry")
             .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where(F.col("toxic") >= least_support)
             # the same log odds as choose_entries, here only to send less to the driver
             .where(F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
                    >= least_weight - 1e-9))
    lexicon = Lexicon(choose_entries([tuple(r) for r in found.select("entry", "clean", "toxic").collect()],
                                     clean, toxic, least_weight))
    if not lexicon.weights:
        return lexicon
    lexicon.exceptions = _learn_exceptions(sample, lexicon, clean, toxic)

    def densities(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = [math.log1p(max(0.0, lexicon.density(fold(t)))) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(z, pa.float64()), b.column(1)], names=["z", "y"])

    points = sample.mapInArrow(densities, "z double, y int").collect()  # two numbers per sampled row
    lexicon.slope, lexicon.offset = _logistic(np.array([r["z"] for r in points]), np.array([r["y"] for r in points]))
    return lexicon


def _learn_exceptions(sample: DataFrame, lexicon: Lexicon, clean: int, toxic: int, least: int = 3) -> set[str]:
    """Two-word phrases around a match that occur in at least ``least`` clean
    texts and, by rate, ten times rarer in toxic ones."""
    def phrases(batches) -> Iterator[pa.RecordBatch]:
        tally = (Counter(), Counter())
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                folded, seen = fold(t), set()
                for s, _, _ in lexicon.matches(folded):
                    end = folded.index(" ", s + 1)
                    after = folded.find(" ", end + 1)
                    before = folded.rfind(" ", 0, s)
                    if after > 0:
                        seen.add(folded[s:after + 1])
                    if before >= 0:
                        seen.add(folded[before:end + 1])
                tally[y].update(seen)
        for y in (0, 1):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(tally[y]), pa.string()), pa.array([n * (1 - y) for n in tally[y].values()], pa.int64()),
                 pa.array([n * y for n in tally[y].values()], pa.int64())], names=["phrase", "clean", "toxic"])

    found = (sample.mapInArrow(phrases, "phrase string, clean long, toxic long").groupBy("phrase")
             .agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
             .where((F.col("c") >= least) & (F.col("t") * 10 * clean <= F.col("c") * toxic)))
    return {r["phrase"] for r in found.select("phrase").collect()}


def _logistic(z: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and offset of a one-variable logistic fit (Newton steps)."""
    x = np.stack([z, np.ones_like(z)], 1)
    b = np.array([1.0, -2.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (y - p) - ridge * b
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(b[0], 1e-3)), float(b[1])


def score_toxicity(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, score (0 to 1), predicted (1 if score >= 0.5) for every
    row's whole text. Null and empty texts match nothing and get the score of
    such texts. Repeated rows and null ids are kept; an empty table gives no
    rows; other columns are ignored."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.array([lexicon.score(t.as_py()) for t in b.column(1)], np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             names=["id", "score", "predicted"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)
