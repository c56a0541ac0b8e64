import math
import random
import zlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod
from tessera.llm.toxicity import Lexicon, choose_entries, fold, learn_lexicon, score_toxicity, stems

SCHEMA = "doc_id long, text string"


def test_folding():
    assert fold("Ｉd1оt!") == " idiot "            # full width, digit, Cyrillic o
    assert fold("$tup1d  M0R0N.\n12 a@b") == " stupid moron aab "
    assert fold("1234 15.1") == " " and fold(None) == " " and fold("") == " "
    assert fold("mo​ron") == " moron " and fold("Ünï") == " ünï "


def test_folding_keeps_runs_of_signs_inside_words():
    assert fold("a$$ a55 p155") == " ass ass piss " and fold("x100t 55hit") == " xioot sshit "
    assert fold("55 a @$ b 1,000") == " a b "


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_folded_words_have_single_spaces_around(text):
    f = fold(text)
    assert f[0] == f[-1] == " " and "  " not in f and not set(f) & set("01345780@$.!<\n\t")


def test_matching_at_word_starts_longest_entry_and_exceptions():
    lex = Lexicon({" idio": 1.0, " idiot": 2.0, " ass ": 4.0}, {" ass ears "})
    assert lex.matches(fold("Idiot idiom class ass")) == [(0, " idiot", 2.0), (6, " idio", 1.0), (18, " ass ", 4.0)]
    assert lex.matches(fold("ass ears")) == [] and len(lex.matches(fold("ears ass ass ears"))) == 1


def brute_matches(lex, folded):
    out = []
    for s in range(len(folded)):
        here = [e for e in lex.weights if folded.startswith(e, s)]
        if here:
            e = max(here, key=len)
            spans = [(a, a + len(p) - 1) for p in lex.exceptions for a in range(len(folded)) if folded.startswith(p, a)]
            if not any(a <= s and s + len(e.rstrip()) - 1 <= b for a, b in spans):
                out.append((s, e, lex.weights[e]))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab abc abcd b ba c".split()), max_size=12))
def test_matches_equal_brute_force(words):
    lex = Lexicon({" ab": 1.0, " abc": 2.0, " b ": 3.0, " c ": 1.5}, {" b ba ", " ba c ", " abc ab "})
    folded = fold(" ".join(words))
    assert lex.matches(folded) == brute_matches(lex, folded)


def test_entries_are_the_longest_stems_with_the_support():
    rows = [(" loweia", 0, 9), (" loweib", 0, 9), (" lowei", 0, 18), (" lowe", 0, 18), (" of ", 90, 9)]
    assert set(choose_entries(rows, 100, 100, 1.0)) == {" lowei"}
    assert stems({"ab", "abcdef"}) == {" ab ", " abcd", " abcde", " abcdef"}


@pytest.fixture(scope="module")
def learned(spark):
    rng = random.Random(3)
    plain, bad = [f"word{i}" for i in range(300)], ["stupid", "moron", "scumbag", "lostraan", "lostraei", "lostraum"]
    docs, labels = [], []
    for k in range(900):
        toxic = k % 5 == 0
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 120))]
        if toxic:
            for _ in range(max(2, len(words) // 30)):
                w = rng.choice(bad)
                words[rng.randrange(len(words))] = w.replace("o", "0") if k % 3 == 0 else w.title()
        elif k % 80 == 1:
            words[5:7] = ["scumbag", "fish"]  # a harmless phrase
        docs.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    d = spark.createDataFrame(docs, SCHEMA)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("*", "1 as quality", "'x' as text")
    return d, dict(labels), learn_lexicon(d, lab, crc_mod("doc_id", 5) != 0)


def test_held_out_quality(spark, learned):
    docs, truth, lex = learned
    assert " lostra" in lex.weights and " scumbag fish " in lex.exceptions
    got = {r["doc_id"]: r for r in score_toxicity(docs, lex).collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i]["predicted"] == truth[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())


def test_unusual_texts(spark, learned):
    _, _, lex = learned
    rows = [(1, None), (2, ""), (3, "moron " * 50_000), (None, "calm words"), (3, "moron"), (4, "fine " * 200_000)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as score", "2 as id", "3 as predicted")
    got = [(r["doc_id"], r["predicted"]) for r in score_toxicity(df, lex).collect()]
    assert sorted(got, key=str) == sorted([(1, 0), (2, 0), (3, 1), (None, 0), (3, 1), (4, 0)], key=str)
    assert score_toxicity(df.limit(0), lex).collect() == []


def test_without_labels_or_toxic_rows(spark):
    docs = spark.createDataFrame([(1, "a")], SCHEMA)
    for labels in ([], [(1, 0)], [(1, None), (None, 1)]):
        lex = learn_lexicon(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
        (r,) = score_toxicity(docs, lex).collect()
        assert lex.weights == {} and r["predicted"] == 0 and math.isfinite(r["score"])


def test_exception_spans_against_all_pairs_and_long_texts():
    import random
    import time
    rng = random.Random(3)
    weights = {" ab": 1.0, " b ": 2.0, " abc ": 3.0, " c": 4.0}
    exceptions = {" ab b ", " b c ", " abc b ab ", " c c "}
    lexicon = Lexicon(weights, exceptions)
    for _ in range(300):
        folded = " " + " ".join(rng.choice(["ab", "b", "abc", "c", "abx"]) for _ in range(rng.randrange(1, 15))) + " "
        covered = [(i, i + len(e) - 1) for e in exceptions for i in range(len(folded)) if folded.startswith(e, i)]
        best = {}
        for e, w in weights.items():
            for i in range(len(folded)):
                if folded.startswith(e, i) and (i not in best or len(e) > len(best[i][0])):
                    best[i] = (e, w)
        want = [(s, e, w) for s, (e, w) in sorted(best.items())
                if not any(a <= s and s + len(e.rstrip()) - 1 <= b for a, b in covered)]
        assert lexicon.matches(folded) == want
    long = " " + "ab b " * 100_000
    began = time.time()
    assert lexicon.matches(long) == []
    assert time.time() - began < 20
