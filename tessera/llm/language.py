"""Language identification in two steps (operator 3): first the language
family, then one-versus-one linear support vector machines between the
languages of that family."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

from .common import discard

# Families of common language codes; any other code is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "bg": "slavic", "sk": "slavic",
    "fi": "uralic", "et": "uralic", "hu": "uralic", "tr": "turkic", "az": "turkic", "kk": "turkic",
}
_NO_LETTER = re.compile(r"[\W\d_]*")


def has_letter(text: str | None) -> bool:
    """Whether any character counts as a letter (``str.isalpha``)."""
    if not text:
        return False
    rest = text[_NO_LETTER.match(text).end():]
    return any(map(str.isalpha, rest))


def gram_codes(text: str, buckets: int) -> np.ndarray:
    """Hashed trigrams of the lower-cased text's UTF-8 bytes; digits and white
    space count as one kind of separator."""
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "replace") + b" ", np.uint8).astype(np.uint32)
    raw = np.where(raw < 65, np.uint32(32), raw)
    codes = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    codes = codes[~((raw[:-2] == 32) & (raw[1:-1] == 32))]
    return (codes * np.uint32(2654435761) >> np.uint32(12)) % buckets


def profile(text: str, buckets: int) -> np.ndarray:
    """Relative frequencies of the hashed trigrams of the whole text."""
    codes = gram_codes(text, buckets)
    return np.bincount(codes, minlength=buckets) / max(len(codes), 1)


@dataclass
class LanguageModel:
    """``families``: family -> languages. ``duels``: (scope, a, b) -> weights
    and intercept; a positive margin votes for b. Scope "" is between families."""

    buckets: int
    families: dict[str, list[str]]
    duels: dict[tuple[str, str, str], tuple[np.ndarray, float]] = field(default_factory=dict)

    def _winner(self, scope: str, names: list[str], codes: np.ndarray) -> tuple[str, float]:
        if len(names) == 1:
            return names[0], 1.0
        votes, sure = dict.fromkeys(names, 0), {n: [] for n in names}
        for a, b in combinations(names, 2):
            w, c = self.duels[scope, a, b]
            p = 1 / (1 + np.exp(-np.clip(2 * (w[codes].mean() + c), -40, 40)))
            votes[b if p > 0.5 else a] += 1
            sure[a].append(1 - p)
            sure[b].append(p)
        # most votes; between equals the greater total, then the smaller name
        best = max(names, key=lambda n: (votes[n], sum(sure[n]), [-ord(c) for c in n]))
        return best, float(min(sure[best]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score from 0 to 1); ("und", 0) without any letter."""
        if not self.families or not has_letter(text):
            return "und", 0.0
        codes = gram_codes(text, self.buckets)
        if not len(codes):
            return "und", 0.0
        fam, p = self._winner("", sorted(self.families), codes)
        lang, q = self._winner(fam, self.families[fam], codes)
        return lang, p * q


def train(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          sample_per_language: int = 1000, buckets: int = 2048, iterations: int = 40, reg: float = 1e-4,
          seed: int = 11) -> LanguageModel:
    """Fit on rows where ``learn`` holds and the language is not null.

    At most about ``sample_per_language`` rows of each language are used: rows
    whose seeded id hash is below the language's share (the documented bound
    of the fit). Their whole texts become hashed trigram profiles; each duel
    is a ``LinearSVC`` over them. Only weights reach the driver.
    """
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(F.col(lang_col).alias("l")).count().collect()}
    families: dict[str, list[str]] = {}
    for lang in sorted(counts):
        families.setdefault(FAMILIES.get(lang, lang), []).append(lang)
    model = LanguageModel(buckets, families)
    if len(counts) < 2:
        return model
    draw = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(seed)), F.lit(1 << 30))
    chosen = F.lit(False)
    for lang, n in counts.items():
        chosen = chosen | ((F.col(lang_col) == lang) & (draw < int((1 << 30) * min(1.0, sample_per_language / n))))

    def profiles(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo in range(0, len(texts), 100):
                keep = [(t, g) for t, g in zip(texts[lo:lo + 100], langs[lo:lo + 100]) if has_letter(t)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g for _, g in keep], pa.string()),
                     pa.array([profile(t, buckets) for t, _ in keep], pa.list_(pa.float64()))], names=["lang", "f"])

    sample = materialize(rows.where(chosen).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
                         .mapInArrow(profiles, "lang string, f array<double>"), "langs")
    written = sample
    # every step of a fit is a job over the sample: few partitions for a few thousand rows
    parts = max(1, -(-len(counts) * sample_per_language // 1000))
    sample = sample.select("lang", array_to_vector("f").alias("features")).coalesce(parts).persist()
    present = {r[0] for r in sample.select("lang").distinct().collect()}
    model.families = {f: [g for g in langs if g in present] for f, langs in families.items()
                      if any(g in present for g in langs)}

    def duel(of_a: list[str], of_b: list[str]) -> tuple[np.ndarray, float]:
        part = (sample.where(F.col("lang").isin(of_a + of_b))
                .withColumn("label", F.col("lang").isin(of_b).cast("double")))
        fit = LinearSVC(maxIter=iterations, regParam=reg).fit(part)
        return fit.coefficients.toArray(), float(fit.intercept)

    for a, b in combinations(sorted(model.families), 2):
        model.duels["", a, b] = duel(model.families[a], model.families[b])
    for fam, langs in model.families.items():
        for a, b in combinations(langs, 2):
            model.duels[fam, a, b] = duel([a], [b])
    sample.unpersist()
    discard(written)
    return model


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, lang_pred, score for every row's whole text. Null text or
    text without a letter: ``und`` with score 0. Repeated rows and null ids are
    kept; an empty table gives no rows; other columns are ignored."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [model.predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())],
                names=["id", "lang_pred", "score"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def keep_identified(docs: DataFrame, model: LanguageModel, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, whose language is identified with a
    score of at least ``least`` (one pass, no join)."""
    schema = docs.schema
    at = docs.columns.index(text_col)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for t in b.column(at):
                lang, score = model.predict(t.as_py())
                ok.append(lang != "und" and score >= least)
            yield b.filter(pa.array(ok, pa.bool_()))

    return docs.mapInArrow(run, schema)
