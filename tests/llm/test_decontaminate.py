import random

import numpy as np
import pytest

from tessera.llm.common import word_hashes
from tessera.llm.decontaminate import decontaminate, keep_clean, tiles, tokens_of

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def slow_tiles(doc, item, least):
    """Greedy string tiling as published, by trying all pairs of positions."""
    dd, ii, out = [False] * len(doc), [False] * len(item), []
    while True:
        best, found = least - 1, []
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while (i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n]
                       and not ii[i + n] and not dd[d + n]):
                    n += 1
                if n > best:
                    best, found = n, [(d, i, n)]
                elif n == best >= least:
                    found.append((d, i, n))
        if best < least:
            return out
        for d, i, n in found:
            if not any(dd[d:d + n]) and not any(ii[i:i + n]):
                out.append((d, i, n))
                dd[d:d + n] = [True] * n
                ii[i:i + n] = [True] * n


@pytest.mark.parametrize("seed", range(60))
def test_tiles_equal_the_published_procedure(seed):
    rng = random.Random(seed)
    item = [rng.choice("abcde"[:2 + seed % 4]) for _ in range(rng.randrange(1, 30))]
    doc = [rng.choice("abcdef") for _ in range(rng.randrange(0, 20))]
    for _ in range(3):
        a, b = sorted(rng.randrange(len(item) + 1) for _ in range(2))
        doc += item[a:b] + [rng.choice("xyz")]
    least = rng.choice([1, 2, 3, 5])
    x, y = word_hashes(doc), word_hashes(item)
    assert tiles(x, y, least) == slow_tiles(doc, item, least)


def brute(docs, items, least=5, coverage=0.8):
    out = []
    for d, t in docs:
        hits = []
        for k, u in items:
            a, b = tokens_of(t), tokens_of(u)
            if b:
                m = min(least, len(b))
                got = sum(n for *_, n in slow_tiles(a, b, m)) if len(b) >= least else len(b) * any(
                    a[i:i + m] == b for i in range(len(a) - m + 1))
                if got:
                    hits.append((got / len(b), k))
        best = min(hits, key=lambda h: (-h[0], h[1]), default=(0.0, None))
        n = sum(h[0] >= coverage for h in hits)
        out.append((d, round(best[0], 9), best[1], n, n > 0))
    return sorted(out, key=str)


def fixture():
    rng = random.Random(8)
    vocab = [f"v{i}" for i in range(60)]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.choice([2, 4, 20, 40])))) for k in range(8)]
    items += [(8, None), (9, ""), (10, items[3][1].upper()), (11, "the the the the the the the")]
    docs = []
    for k in range(50):
        words = [rng.choice(vocab) for _ in range(rng.randrange(0, 60))]
        if k % 2:
            part = items[rng.randrange(8)][1].split()
            cut = rng.randrange(len(part) + 1)
            part = part[cut:] + ["zz"] + part[:cut]  # reordered
            words[len(words) // 2:len(words) // 2] = part
        docs.append((k, ", ".join(words)))
    docs += [(50, None), (51, ""), (52, "the " * 3000), (None, items[2][1]), (1, docs[1][1])]
    return docs, items


@pytest.mark.parametrize("block_chars", [8_000_000, 300])
def test_equals_brute_force(spark, block_chars):
    docs, items = fixture()
    df = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as id", "2 as coverage", "3 as n_items").repartition(3)
    got = decontaminate(df, spark.createDataFrame(items, ITEMS), block_chars=block_chars).collect()
    assert sorted(((r["doc_id"], round(r["coverage"], 9), r["item_id"], r["n_items"], r["contaminated"]) for r in got), key=str) == brute(docs, items)


def test_reordered_passage_is_caught_and_half_a_passage_is_not(spark):
    words = [f"q{i}" for i in range(30)]
    items = spark.createDataFrame([(0, " ".join(words))], ITEMS)
    docs = spark.createDataFrame([(1, "a b " + " ".join(words[15:] + ["x"] + words[:15])), (2, " ".join(words[:15])), (3, "clean text")], DOCS)
    assert {r["doc_id"]: r["contaminated"] for r in decontaminate(docs, items).collect()} == {1: True, 2: False, 3: False}
    kept = keep_clean(docs.selectExpr("*", "1 as _bad"), items)
    assert kept.columns == ["doc_id", "text", "_bad"] and sorted(r["doc_id"] for r in kept.collect()) == [2, 3]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a")], DOCS), spark.createDataFrame([], ITEMS)
    (r,) = decontaminate(docs, items).collect()
    assert (r["coverage"], r["item_id"], r["n_items"], r["contaminated"]) == (0.0, None, 0, False)
    assert decontaminate(docs.limit(0), spark.createDataFrame([(1, "a b")], ITEMS)).collect() == []


def test_window_hashes():
    from tessera.llm.decontaminate import _window_hashes
    x = np.array([3, 1, 4, 1, 5, 1, 4, 1, 5], np.uint64)
    for s in range(1, 10):
        h = _window_hashes(x, s)
        assert len(h) == len(x) - s + 1
        for a in range(len(h)):
            for b in range(len(h)):
                assert (h[a] == h[b]) == (x[a:a + s].tolist() == x[b:b + s].tolist())
