"""Near-equal lines against shingles that this file defines itself."""

import random

from pyspark.sql import functions as F

from tessera.llm.line_dedup import _bands, _least, dedup_lines

SCHEMA = "doc_id long, text string"


def grams(x, size=5):
    return {x[k:k + size] for k in range(max(1, len(x) - size + 1))}


def jaccard(x, y):
    return len(grams(x) & grams(y)) / len(grams(x) | grams(y))


def test_lines_that_differ_late_in_long_words_stay(spark):
    pairs = [("order-0000012345", "order-0000099999"), ("2024-01-01T12:34:56", "2024-01-01T23:59:56"),
             ("internationalisation of responsibilities", "internationalization of responsibility"),
             ("https://example.org/a/first/one", "https://example.org/b/other/two"), ("😀😁😂🤣😃😄", "😀😁😂🤣😃😅"), ("abcd", "abce")]
    assert all(jaccard(x, y) < 0.8 for x, y in pairs)
    rows = [(2 * k + j, line) for k, p in enumerate(pairs) for j, line in enumerate(p)]
    assert sorted(map(tuple, dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect())) == rows


def near_copies(words, n=150):
    """Pairs of lines that differ in one letter, with a Jaccard of 0.8 or more."""
    rng, out = random.Random(words), []
    while len(out) < n:
        x = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 8))) for _ in range(words))
        k = rng.randrange(len(x))
        y = x[:k] + "#" + x[k + 1:]
        if jaccard(x, y) >= 0.8:
            out.append((x, y))
    return out


def test_lines_with_one_changed_letter_are_found(spark):
    pairs = near_copies(9) + near_copies(12) + near_copies(15)
    rows = [(2 * k + j, line) for k, p in enumerate(pairs) for j, line in enumerate(p)]
    kept = dict(map(tuple, dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert all(kept[2 * k] == x for k, (x, _) in enumerate(pairs))
    assert sum(kept[2 * k + 1] == "" for k in range(len(pairs))) >= 0.97 * len(pairs)


def test_recall_of_the_bands_on_short_lines(spark):
    """Pairs at a Jaccard of exactly 0.8 (8 of 10 shingles): 0.986 are found."""
    rng, pairs = random.Random(4), 8000
    rows = []
    for p in range(pairs):
        g = [rng.getrandbits(64) - (1 << 63) for _ in range(10)]
        rows += [(p, side, x) for side in (0, 1) for x in g[:8] + [g[8 + side]]]
    df = spark.createDataFrame(rows, "pair long, side int, g long").groupBy("pair", "side").agg(*_least(F.col("g"), 18, 9))
    both = df.select("pair", F.array(*_bands(6, 3)).alias("b")).groupBy("pair").agg(F.collect_list("b").alias("b"))
    found = both.where(F.size(F.array_intersect(F.col("b")[0], F.col("b")[1])) > 0).count()
    assert 0.981 <= found / pairs <= 0.992
