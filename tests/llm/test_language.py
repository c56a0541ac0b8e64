import zlib

import pytest
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod
from tessera.llm.language import LanguageModel, has_letter, identify, keep_identified, train

SCHEMA = "doc_id long, text string, lang string"
WORDS = {"en": "the and of thing with this that other which there", "de": "der und die nicht schön für über eine auch über",
         "fr": "le et une être déjà avec pour où été les", "es": "el y una niño también está para los qué señor"}


def make(n):
    rows, k = [], 0
    for lang, words in WORDS.items():
        words = words.split()
        for i in range(n):
            rows.append((k, " ".join(words[(i * j + j) % len(words)] for j in range(1, 12 + i % 7)), lang))
            k += 1
    return rows


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.createDataFrame(make(60), SCHEMA)
    return docs, train(docs, crc_mod("doc_id", 3) != 1, iterations=20)


def test_held_out_accuracy_and_hierarchy(fitted):
    docs, model = fitted
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    assert set(model.duels) == {("", "germanic", "romance"), ("germanic", "de", "en"), ("romance", "es", "fr")}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}
    got = {r["doc_id"]: r for r in identify(docs, model).collect()}
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert sum(got[i]["lang_pred"] == t for i, t in truth.items()) >= 0.95 * len(truth)


def test_unusual_texts(spark, fitted):
    _, model = fitted
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (4, "the " * 100_000), (None, "der und die"), (4, "the " * 100_000), (5, "_²"), (6, "ñ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as score", "3 as lang_pred")
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in identify(df, model).collect()]
    assert len(got) == len(rows)
    assert {i: p for i, p, _ in got if i in (1, 2, 3, 5)} == {1: "und", 2: "und", 3: "und", 5: "und"}
    assert all(s == 0 for i, p, s in got if p == "und") and {p for i, p, _ in got if i == 4} == {"en"}
    assert [p for i, p, _ in got if i is None] == ["de"]
    kept = keep_identified(df, model, 0.3)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} >= {4, None}
    assert not {1, 2, 3, 5} & {r["doc_id"] for r in kept.collect()}


def test_letters():
    assert has_letter("  12é") and has_letter("字") and not has_letter("12 _-²٣") and not has_letter(None)


def test_empty_one_language_and_unlabelled(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = train(empty, F.lit(True))
    assert model.families == {} and identify(empty, model).collect() == []
    assert model.predict("abc") == ("und", 0.0)
    one = spark.createDataFrame([(1, "aa", "xx"), (2, "bb", None)], SCHEMA)
    assert train(one, F.lit(True)).predict("zz") == ("xx", 1.0)


def test_ties_do_not_crash():
    import numpy as np
    m = LanguageModel(8, {"a": ["x", "y"]}, {("a", "x", "y"): (np.zeros(8), 0.0)})
    assert m.predict("text")[0] in ("x", "y")
