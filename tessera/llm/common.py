"""Helpers shared by the training-data operators.

Conventions of every operator here:

- It reads only the columns named in its arguments and renames them, so extra
  columns, whatever their names, neither reach it nor clash with its own.
- Intermediate tables that later jobs read twice are written below the shared
  folder of ``spark.checkpoint.dir`` (``tessera.session.materialize``).
- Random choices are seeded hashes, so a re-run task gives the same rows.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

M64 = (1 << 64) - 1


@contextmanager
def session_conf(spark: SparkSession, **conf: str):
    """Session settings for the eager jobs inside the block; the old values
    come back afterwards. Dots in a setting's name are written ``__``."""
    old = {}
    for k, v in conf.items():
        k = k.replace("__", ".")
        old[k] = spark.conf.get(k, None)
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def freed_shuffles(spark: SparkSession):
    """Each job inside the block deletes its own shuffle files when it ends,
    not when the driver happens to collect its garbage: for chains of jobs
    that write what the next one reads."""
    return session_conf(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def small_batches(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows, for rows with large payloads."""
    return session_conf(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(rows))


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables written by ``materialize`` that no later
    job reads, so that the shared folder holds only what is still needed."""
    for df in tables:
        files = df.inputFiles()
        if files:
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
            path = jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
            path.getFileSystem(conf).delete(path, True)


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to ``limit`` words per worker
    (beyond it words are hashed each time: memory stays bounded)."""

    limit = 300_000

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.limit:
            self[word] = h
        return h


_WORDS = WordHashes()


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None) -> list[str]:
    """Lower-cased words between white space."""
    return text.lower().split() if text else []


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads the bits of 64-bit values (fixed constants of
    the public splitmix64 generator)."""
    h = h.copy()
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def shingle_hashes(words: list[str], n: int) -> np.ndarray:
    """Hashes of the word n-grams in order; a text of 1 to n-1 words has one
    shingle, all of it. No words: no shingles."""
    if not words:
        return np.empty(0, np.uint64)
    w = word_hashes(words)
    n = min(n, len(w))
    m = len(w) - n + 1
    h = np.zeros(m, np.uint64)
    for i in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[i:i + m]
        h ^= h >> np.uint64(29)
    return mix(h)


def bits(h: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the signed ones Spark stores."""
    return h.astype(np.uint64).view(np.int64)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def crc_mod(col: str, mod: int):
    """crc32 of the id as text, modulo ``mod`` (null id: null)."""
    return F.crc32(F.col(col).cast("string")) % mod
