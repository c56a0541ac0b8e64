import __spark_entry__ as E
import corpus_pipeline as C
import pytest

from tessera.llm.decontaminate import tokens_of
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_ngram_join import brute as brute_join

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_registered_and_stages():
    names = set(E.queries())
    assert "pipeline" in names and C.ORACLE_SQL is None
    for n in range(1, 11):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert [k for k, _ in C.STAGES] == ["language_id", "line_dedup", "ngram_jaccard_join", "decontamination", "packing"]


def test_stages_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    first = C.identify_language(spark, docs, SF)
    assert first.schema == docs.schema
    kept = first.collect()
    assert all(r == rows[r["doc_id"]] for r in kept) and len(kept) > 0.9 * len(rows)

    second = C.drop_repeated_lines(spark, docs, SF)
    assert second.columns == docs.columns and [f.dataType for f in second.schema] == [f.dataType for f in docs.schema]
    lines = {r["doc_id"]: r for r in second.collect()}
    assert {i: r["text"] for i, r in lines.items()} == dict(brute_lines([(i, r["text"]) for i, r in sorted(rows.items())]))
    assert all(r["n_chars"] == len(r["text"]) for r in lines.values())

    third = C.join_near_duplicates(spark, docs, SF)
    want = brute_join([(i, r["text"]) for i, r in rows.items()])
    assert {r["doc_id"]: r for r in third.collect()} == {i: r for i, r in rows.items() if want[i][2] == i}

    fourth = C.remove_benchmark(spark, docs, SF)
    items = [tokens_of(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r["doc_id"] for r in fourth.collect()}
    for i, r in rows.items():
        words = " " + " ".join(tokens_of(r["text"])) + " "
        if any(f" {' '.join(t)} " in words for t in items if len(t) >= 5):
            assert i not in left
    assert len(left) > 0.9 * len(rows)


def test_run_packs_what_is_left(spark):
    out = C.run(spark, SF).collect()
    assert out and len({(r["doc_id"], r["piece"]) for r in out}) == len(out)
    ends = {}
    for r in out:
        ends.setdefault(r["sequence_id"], []).append((r["offset"], r["offset"] + r["length"]))
    assert all(max(e for _, e in s) == sum(e - b for b, e in s) <= 1024 for s in ends.values())


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(None, "", "en", "s", 0)],
                                  [(k, t, "en", None, 3) for k in (1, 1, 2) for t in ("the cat", "the cat", None)]])
def test_unusual_tables(spark, rows, tmp_path):
    spark.read.parquet(f"{SF}/benchmark.parquet").limit(3).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame(rows, DOCS)
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    C.pack(spark, docs, str(tmp_path)).collect()
