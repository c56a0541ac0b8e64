import random
import re
from collections import Counter

import numpy as np
import pytest

from tessera.llm import textblocks
from tessera.llm.collocations import collocations

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, longest=4, least=30, top=2000, cover=80):
    count, total = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, longest + 1):
                for i in range(len(w) - n + 1):
                    count.setdefault(lang, Counter())[tuple(w[i:i + n])] += 1
    out = []
    for lang, f in count.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            cuts = [(2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            longer = [b for q, b in found.items() if len(q) > len(p)
                      and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * b >= cover * a for b in longer):
                score, _, left, right = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as block", "2 as n", "3 as `key`", "4 as phrase")
    return sorted(tuple(r) for r in collocations(df.repartition(3), **options).collect())


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = "The the OF of and état ßé İx zu New york city in law a\x00b".split(" ")
    fixed = ["new york city hall", "of the", "in spite of", "état of the art", "and and and and and"]
    rows = []
    for k in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        text = "".join(p + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", "\x0b"]) for p in parts)
        rows.append((k, text, rng.choice(["en", "en", "de", None, "und", ""])))
    return rows + [(n, None, "en"), (n + 1, "", "fr"), (n + 2, "only one", "it"), rows[0], rows[0]]


@pytest.mark.parametrize("seed, options", [(1, {"least": 5}), (2, {"least": 30}), (3, {"least": 2, "longest": 3, "top": 7}),
                                           (4, {"least": 3, "cover": 100})])
def test_equals_brute_force(spark, seed, options):
    rows = corpus(seed)
    assert run(spark, rows, **options) == brute(rows, **options)


def test_colliding_fingerprints_change_nothing(spark):
    """With 8-bit fingerprints nearly every phrase shares its own with a frequent one."""
    rows = corpus(5, 60)
    assert run(spark, rows, least=4, fp_bits=8) == brute(rows, least=4)


def test_one_word_many_times_and_a_long_text(spark):
    rng = random.Random(6)
    long = " ".join(rng.choice("abcdefgh") for _ in range(30_000))
    rows = [(1, "very " * 20_000, "en"), (2, long, "en"), (3, "very very, very", "en")]
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_a_table_without_words(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, None), (2, " .,; ", "en")], least=1) == []


def test_scores_beyond_64_bits(spark):
    """2000000 a passes 64 bits for counts near 2^63."""
    a = (1 << 62) + 12345
    row = spark.sql(f"SELECT cast(2000000 as decimal(7,0)) * cast({a}L as decimal(20,0)) "
                    f"div (cast({a}L as decimal(20,0)) + cast({a + 7}L as decimal(20,0))) AS s").first()
    assert row["s"] == 2000000 * a // (2 * a + 7)


def test_equal_spans_have_equal_hashes():
    values = np.frombuffer(b"abcabcab" * 50, np.uint8)
    at = np.arange(300)
    h = textblocks.span_hashes(values, at, at + 9)
    text = values.tobytes()
    assert {(text[i:i + 9], int(h[i])) for i in at} == {(text[i:i + 9], int(h[i])) for i in at[:8]}


def test_packed_lists_come_back():
    rng = np.random.default_rng(7)
    for bits in (1, 20, 63, 64):
        fps = np.unique(rng.integers(0, 1 << bits, 500, np.uint64, endpoint=bits < 64) if bits < 64
                        else rng.integers(0, np.iinfo(np.uint64).max, 500, np.uint64))
        assert (textblocks._unpack(textblocks._pack(fps, 0), len(fps), 0) == fps).all()


def test_words_whose_hashes_collide_stay_apart(monkeypatch):
    words = textblocks.find_words([b"one two three two one", b"three"])
    words.hashes = np.zeros(len(words.starts), np.uint64)
    of, first = words.classes()
    assert of.tolist() == [0, 1, 2, 1, 0, 2] and first.tolist() == [0, 1, 2]
