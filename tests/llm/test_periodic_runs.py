import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tessera.llm.periodic_runs import find_runs, periodic_runs
from tessera.llm.queries import QUERIES, repeat_tails

SCHEMA = "doc_id long, text string"


def smallest_period(x):
    return next(q for q in range(1, len(x) + 1) if all(x[i] == x[i + q] for i in range(len(x) - q)))


def brute_runs(x, least=4, shortest=6):
    out, n = [], len(x)
    for q in range(1, n // least + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(shortest, least * q) and smallest_period(x[i:j + q]) == q:
                out.append((i, j + q - i, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, text):
    words = words_of(text)
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def collapsed(words, runs):
    gone = set()
    for s, n, q in runs:
        gone.update(range(s + q, s + n))
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for size in (0, 1, 5, 6, 7, 30, 90, 150):
        for letters in (1, 2, 3, 9):
            for _ in range(12):
                x = [rng.randrange(letters) for _ in range(size)]
                if size > 20 and rng.random() < 0.7:  # a repeated stretch, cut anywhere
                    p, at = rng.randrange(1, 15), rng.randrange(size)
                    for i in range(at + p, min(size, at + p * rng.randrange(2, 9) + rng.randrange(p))):
                        x[i] = x[i - p]
                assert find_runs(np.array(x, np.int64)) == brute_runs(x), x


def test_runs_of_runs():
    a = [0] * 7
    for x in ([1, *a] * 9, (a + [1]) * 4 + a, [0, 1] * 40 + [2] + [0, 1] * 40, list(range(50)) * 4, [5] * 400,
              ([0, 1] * 6 + [2]) * 5, [0, 0, 1] * 20 + [0, 0] * 20):
        assert find_runs(np.array(x, np.int64)) == brute_runs(x)
    assert find_runs(np.array([3] * 50), 5, 20) == [(0, 50, 1)]


def corpus():
    rng = random.Random(2)
    rows = []
    for k in range(150):
        words = [rng.choice("the cat sat on a mat état of x".split()) for _ in range(rng.randrange(120))]
        if rng.random() < 0.4 and len(words) > 20:
            words = (words[:3] + words[3:3 + rng.randrange(1, 9)] * rng.randrange(1, 9) + words[9:14]
                     + words[14:14 + rng.randrange(1, 4)] * rng.randrange(6, 9) + words[17:])
        rows.append((k, "".join(w + rng.choice([" "] * 20 + ["\n", "\t ", "\x0b", "\u00a0"]) for w in words)))
    return rows + [(200, None), (201, ""), (202, " \n "), (203, "a " * 30_000), (204, "word"), rows[3], rows[3], (None, "b b b b b b")]


def test_operator_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as runs", "2 as id", "3 as starts", "4 as n_words")
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"])
                  for r in periodic_runs(df.repartition(4)).collect()), key=str)
    want = []
    for d, text in rows:
        words = words_of(text)
        runs = brute_runs(words) if d != 203 else [(0, 30_000, 1)]
        want.append((d, len(words), runs, collapsed(words, runs)))
    assert got == sorted(want, key=str)


def test_query_equals_brute_force(spark, tmp_path):
    rows = [r for r in corpus() if r[0] is not None and r[0] != 203][:-2]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect())
    want, ties = [], 0
    for d, text in rows:
        words = planted(d, text)
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        ties += len(runs) > 1
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((d, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                     sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs))))
    assert got == sorted(want) and ties > 5


def test_planted_tails(spark):
    rows = [(k, " ".join(str(i) for i in range(k % 50))) for k in range(300)] + [(300, None)]
    got = {r["doc_id"]: r["text"] for r in repeat_tails(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(words_of(bytes(got[d] or b"").decode()) == planted(d, t) for d, t in rows)
    assert sum(words_of(t) != planted(d, t) for d, t in rows) > 10


@pytest.mark.parametrize("text", ["x y " * 20_000, "a b c d e f g " * 3_000 + "z"])
def test_long_texts(spark, text):
    n = len(text.split())
    q = 2 if text[0] == "x" else 7
    r = periodic_runs(spark.createDataFrame([(1, text)], SCHEMA)).first()
    assert [tuple(x) for x in r["runs"]] == [(0, n - (q == 7), q)]
    assert r["collapsed"] == " ".join(text.split()[:q] + (["z"] if q == 7 else []))


def test_empty_table(spark):
    assert periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []
