import random
import re
from collections import Counter

import numpy as np
import pytest

from tessera.llm import phrase_automata
from tessera.llm.phrase_automata import remove_phrases

SCHEMA = "doc_id long, text string"


def brute(rows, window=35):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    count = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, split):
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as block", "2 as ids", "3 as spans", "4 as n_words")
    return sorted((tuple(r) for r in remove_phrases(df.repartition(4), **options).collect()), key=str)


def corpus(seed, window=35, n=60):
    rng = random.Random(seed)
    words = "alpha béta Alpha delta the of and zu ñandú x   a b".split(" ")
    passages = [[rng.choice(words) for _ in range(rng.randrange(max(1, window - 3), 3 * window))] for _ in range(8)]
    rows = []
    for k in range(n):
        parts = []
        for _ in range(rng.randrange(6)):
            p = rng.choice(passages)
            if rng.random() < 0.5:  # part of a passage
                a = rng.randrange(len(p))
                p = p[a:a + rng.randrange(len(p))]
            if rng.random() < 0.3:
                p = [rng.choice(words) + str(rng.randrange(999)) for _ in range(rng.randrange(40))]
            parts += p
        text = "".join(w + rng.choice([" ", " ", "\n", "\t ", "\x0c"]) for w in parts)
        if rows and rng.random() < 0.2:
            text = rng.choice(rows)[1]
        rows.append((k, text))
    return rows


@pytest.mark.parametrize("seed, window", [(1, 35), (2, 35), (3, 8), (4, 2), (5, 3)])
def test_equals_brute_force(spark, seed, window):
    rows = corpus(seed, window) + [(100, None), (101, ""), (102, "a " * 34), (103, "b " * 35), (104, "c " * 36),
                                   (105, "d e " * 400), (-1, " \n"), (None, "f " * 50)]
    assert run(spark, rows, window=window) == brute(rows, window)


def test_colliding_fingerprints_change_nothing(spark):
    rows = corpus(6, 10)
    assert run(spark, rows, window=10, fp_bits=5) == brute(rows, 10)


def test_windows_dealt_out_one_by_one(spark, monkeypatch):
    rows = corpus(7, 12)
    whole = run(spark, rows, window=12)
    assert whole == brute(rows, 12)
    monkeypatch.setattr(phrase_automata, "OFTEN", 2)  # every recurring seed counts as very frequent
    assert run(spark, rows, window=12) == whole


def test_one_passage_in_nearly_all_documents(spark):
    rng = random.Random(8)
    shared = " ".join(rng.choice("abcdefgh") * 3 for _ in range(20))  # too short to be a window
    notice = " ".join(rng.choice("ijklmnop") * 3 for _ in range(40))
    rows = []
    for k in range(1500):
        own = [str(rng.randrange(10**6)) for _ in range(30)]
        rows.append((k, " ".join(own[:15] + [shared if k % 3 else notice] + own[15:])))
    got = run(spark, rows)
    assert got == brute(rows)
    assert sum(r[2] == 40 for r in got) == 500 and sum(r[2] == 0 for r in got) == 1000


def test_repeated_rows_and_long_texts(spark):
    rng = random.Random(9)
    long = " ".join(rng.choice("abcd") for _ in range(60_000))
    rows = [(1, long), (1, "short text"), (1, "short text"), (2, " ".join(long.split()[500:900])), (3, "w " * 20_000)]
    assert run(spark, rows) == brute(rows)


def test_windows_whose_hashes_collide_stay_apart(monkeypatch):
    x = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3])
    at = np.arange(7)
    monkeypatch.setattr(phrase_automata, "span_hashes", lambda v, a, b: np.zeros(len(a), np.uint64))
    name = phrase_automata._same_windows(x, at, 3)
    assert (name[0] == name[6]) and len(set(name.tolist())) == 6


def test_empty_table_and_bad_window(spark):
    assert run(spark, []) == []
    with pytest.raises(ValueError):
        run(spark, [(1, "a b")], window=1)
