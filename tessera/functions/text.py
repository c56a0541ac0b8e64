"""Text scalars: word counts, tokenising and padding, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default punctuation filter of the Keras text tokenizer
# (public library behaviour), in its own order; each is replaced by a space.
TOKEN_FILTERS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_count(c: Column | str) -> Column:
    """Number of pieces after splitting on a single space."""
    return F.size(F.split(_col(c), " "))


def tokenize(c: Column | str, filters: str = TOKEN_FILTERS) -> Column:
    """Lower case, filter characters to spaces, split, drop empty pieces."""
    cleaned = F.translate(F.lower(_col(c)), filters, " " * len(filters))
    return F.filter(F.split(cleaned, " "), lambda w: w != F.lit(""))


def pad_sequence(c: Column | str, maxlen: int, value: int = 0) -> Column:
    """Zeros in front; longer arrays keep their last ``maxlen`` items."""
    arr = _col(c)
    n = F.size(arr)
    tail = F.when(n > maxlen, F.slice(arr, n - F.lit(maxlen - 1), maxlen)).otherwise(arr)
    pad = F.array_repeat(F.lit(value), F.greatest(F.lit(maxlen) - n, F.lit(0)))
    return F.concat(pad.cast("array<int>"), tail.cast("array<int>"))
