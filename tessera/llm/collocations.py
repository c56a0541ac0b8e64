"""Phrase collocation mining (operator 11).

Every phrase of up to ``longest`` words is hashed with numpy prefix
polynomials; a shuffle of packed fingerprints finds those that may be
frequent, each with the blocks it occurs in; there the phrases are counted by
their words, so that a collision of fingerprints never joins two phrases. Only
frequent phrases become text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize

from .common import discard, mix
from .textblocks import Scale, Words, _classes, among, block_texts, find_words, listed, recurring, span_hashes, text_blocks

#: Bytes that end a piece, [.,;:!?\x0A-\x0D], and those that end a word.
BREAKS = _classes(b".,;:!?\n\x0b\x0c\r")
GAPS = BREAKS | _classes(b" \t")


def _pieces(words: Words) -> np.ndarray:
    """The number of each word's piece."""
    return np.cumsum(BREAKS[words.buf])[words.starts]


def _phrases(words: Words, pieces: np.ndarray, n: int, key: str) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every phrase of n words; the key is part of it."""
    at = np.arange(max(len(pieces) - n + 1, 0))
    at = at[pieces[at] == pieces[at + n - 1]]
    seed = np.uint64(xxhash.xxh3_64_intdigest(f"{n} {key}"))
    return at, mix(span_hashes(words.hashes, at, at + n) ^ seed)


def _names(classes: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(one place of each different phrase among ``at``, number of places),
    told apart by the classes of their words."""
    name = classes[at]
    for j in range(1, n):
        _, name = np.unique(name * (int(classes.max()) + 1) + classes[at + j], return_inverse=True)
    _, first, count = np.unique(name, return_index=True, return_counts=True)
    return at[first], count


def frequent_phrases(docs: DataFrame, key: Column, text_col: str = "text", longest: int = 4, least: int = 30,
                     fp_bits: int | None = None) -> DataFrame:
    """key, size, phrase, f of every phrase of 1 to ``longest`` words that
    occurs ``least`` times (1 to 255) or more under its key, and for each key
    one row with size 0, an empty phrase and the number of all its words.

    ``fp_bits`` sets the width of the fingerprints (by default it follows the
    corpus); narrower ones give the same result with more work."""
    blocks = text_blocks(docs, text_col, key=key, lower=True).drop("ids")
    scale = Scale.of(blocks, longest / 2)
    if fp_bits is not None:
        scale.bits = max(fp_bits, scale.range_bits)

    def fingerprints(row) -> np.ndarray:
        words = find_words(block_texts(row), GAPS)
        pieces = _pieces(words)
        return np.concatenate([_phrases(words, pieces, n, row.block_key)[1] for n in range(1, longest + 1)])

    def counted(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in it:
            for row in batch.itertuples():
                words, wanted = find_words(block_texts(row), GAPS), listed(row.lists)
                pieces = _pieces(words)
                yield pd.DataFrame({"key": [row.block_key], "size": [0], "phrase": [b""], "f": [len(words.starts)]})
                if not len(wanted):
                    continue
                classes, first = words.classes()
                spelled = [words.word(k) for k in first.tolist()]
                for n in range(1, longest + 1):
                    at, h = _phrases(words, pieces, n, row.block_key)
                    at = at[among(scale.cut(h), wanted)]
                    if len(at):
                        at, f = _names(classes, at, n)
                        ids = zip(*[classes[at + j].tolist() for j in range(n)])
                        phrase = [b" ".join([spelled[c] for c in p]) for p in ids]
                        yield pd.DataFrame({"key": row.block_key, "size": n, "phrase": phrase, "f": f})

    lists = recurring(blocks, fingerprints, least, scale)
    rows = blocks.join(lists, "block", "left").mapInPandas(counted, "key string, size int, phrase binary, f long")
    sums = rows.groupBy("key", "size", "phrase").agg(F.sum("f").alias("f"))
    out = materialize(sums.where((F.col("size") == 0) | (F.col("f") >= least))
                      .withColumn("phrase", F.col("phrase").cast("string")), "phrases")
    discard(blocks)
    return out


def _wide(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = 4,
                 least: int = 30, top: int = 2000, cover: int = 80, fp_bits: int | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top``
    collocations of 2 to ``longest`` words.

    Texts are lower-cased (A-Z only), cut into pieces at punctuation and line
    breaks and those into words at blanks and tabs; a phrase lies within a
    piece. a is the phrase's number of occurrences (``least`` or more), l and
    r those of its parts at the cut with the smallest score
    floor(2000000 a / (l + r)) (ties: the first cut). A phrase goes if a longer
    frequent one that contains it has ``cover`` percent of its occurrences or
    more. Arithmetic is in decimals, hence exact. Order: score, then a, both
    falling, then the phrase by its bytes. n is the number of the language's
    words.

    A null language counts as ``und``, a null text as empty; rows that repeat
    count as often as they are there; a table without a frequent phrase gives
    no row. Other columns, whatever their names, are never read.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    phrases = frequent_phrases(docs, lang, text_col, longest, least, fp_bits)
    total = phrases.where("size = 0").select(F.col("key").alias("lang"), F.col("f").alias("n"))
    found = phrases.where("size > 0").select(F.col("key").alias("lang"), "size", "phrase", F.col("f").alias("a"))
    candidates = found.where("size > 1")
    words = F.split("phrase", " ")

    def part(start: Column, length: Column) -> Column:
        return F.array_join(F.slice(words, start, length), " ")

    k = F.col("k")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "size", "a", "k", part(F.lit(1), k).alias("left"), part(k + 1, F.col("size") - k).alias("right"))
    for side, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(found.select("lang", F.col("phrase").alias(side), F.col("a").alias(count)), ["lang", side])
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))"
                   " div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = (cuts.withColumn("score", score).groupBy("lang", "phrase", "size", "a")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))

    longer = F.explode(F.sequence(F.lit(2), F.col("size") - 1))
    inner = (candidates.where("size > 2").select("lang", "phrase", "size", "a", longer.alias("m"))
             .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
             .select("lang", part(F.col("at"), F.col("m")).alias("phrase"), "a"))
    held = inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = scored.join(held, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (_wide(F.col("most")) * 100 < _wide(F.col("a")) * cover))

    # a language's first are among the first of its parts: no task ranks all its phrases
    order = [F.desc("cut.score"), F.desc("a"), F.asc("phrase")]
    kept = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    for keys in (["lang", "part"], ["lang"]):
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return kept.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a",
                                           "cut.l", "cut.r", "n", "cut.score")
