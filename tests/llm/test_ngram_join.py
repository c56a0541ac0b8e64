import random

import numpy as np
import pytest

from tessera.llm.bucketjoin import shared_counts
from tessera.llm.common import words_of
from tessera.llm.ngram_join import choose_bands, keep_one_per_group, ngram_join

SCHEMA = "doc_id long, text string"


def grams(text, n=5):
    w = words_of(text)
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def brute(rows):
    """doc_id -> (class_id, n_links, component_id); ids are unique here."""
    sets = {i: grams(t) for i, t in rows}
    links = {i: [j for j, s in sets.items() if j != i and s and sets[i]
                 and len(s & sets[i]) >= 0.8 * len(s | sets[i]) - 1e-9] for i in sets}
    out = {}
    for i in sets:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        same = [j for j in sets if sets[j] and sets[j] == sets[i]] or [i]
        out[i] = (min(same), len(links[i]), min(seen))
    return out


def corpus(seed=1):
    rng, rows, k = random.Random(seed), [], 0
    vocab = [f"w{i}" for i in range(400)]
    for _ in range(25):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 6, 40, 200]))]
        for _ in range(rng.choice([1, 1, 3, 12])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            text = " ".join(words)
            rows.append((k, text.upper() if k % 5 == 0 else text.replace(" ", "  \n")))
            k += 1
    rows += [(k, None), (k + 1, ""), (k + 2, " \t"), (k + 3, "one"), (k + 4, "ONE"), (k + 5, "word " * 30_000)]
    return rows


def test_equals_brute_force_with_clashing_columns(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as k", "2 as copies", "'x' as `class_id`", "3 as bands")
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["component_id"]) for r in ngram_join(df).collect()}
    assert got == brute(rows)


def test_hot_group_in_small_blocks(spark, monkeypatch):
    """A bucket cut into many blocks gives the same links."""
    from tessera.llm import ngram_join as module
    from tessera.llm.bucketjoin import bucket_links
    monkeypatch.setattr(module, "bucket_links", lambda *a: bucket_links(*a, block_rows=7, block_size=900))
    rng = random.Random(4)
    base = [f"x{i}" for i in range(120)]
    rows = []
    for k in range(60):
        words = list(base)
        words[rng.randrange(120)] = f"y{k}"
        rows.append((k, " ".join(words)))
    got = {r["doc_id"]: (r["class_id"], r["n_links"], r["component_id"]) for r in ngram_join(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == brute(rows)


def test_repeated_rows_null_ids_and_empty(spark):
    text = "a b c d e f g"
    df = spark.createDataFrame([(5, text), (5, text), (9, text), (None, text), (5, "other words are here now ok"), (None, None)], SCHEMA)
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"], r["component_id"]) for r in ngram_join(df).collect()), key=str)
    assert got == sorted([(5, 5, 3, 5), (5, 5, 3, 5), (9, 5, 3, 5), (None, 5, 3, 5), (5, 5, 0, 5), (None, None, 0, None)], key=str)
    assert ngram_join(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_document_of_each_group_stays(spark):
    rows = corpus(2)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'s' as source")
    kept = keep_one_per_group(df)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, _, c) in brute(rows).items() if i == c}


def test_bands_reach_the_recall():
    for s, recall in ((0.8, 0.99), (0.8, 0.9999), (0.5, 0.95)):
        b, r = choose_bands(s, recall)
        assert 1 - (1 - s ** r) ** b >= recall > 1 - (1 - s ** r) ** (b - 1)


@pytest.mark.parametrize("same", [True, False])
def test_shared_counts(same):
    rng = np.random.default_rng(0)
    left = [np.unique(rng.integers(0, 50, n)) for n in (0, 3, 20, 45)]
    right = left if same else [np.unique(rng.integers(0, 50, n)) for n in (7, 0, 30)]
    got = shared_counts(left, right, width=8)
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            if not (same and i == j):
                assert got[i, j] == len(np.intersect1d(a, b))
