import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tessera.llm.packing import bin_completion, lower_bound, pack_documents
from tessera.llm.tokens import default_path, encoder

SCHEMA = "doc_id long, text string"
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
TOK = Tokenizer.from_file(default_path())


def test_the_fast_merger_is_in_use():
    assert encoder(default_path()).core is not None


@settings(max_examples=500, deadline=None)
@given(st.text(max_size=60) | st.text("ab,. \n", max_size=40) | st.text("añ'\"(-1 \n", max_size=40) | st.text("ab's ll\n\t  é١<|endoftext|>\x1c　ΣΏ9_-", max_size=80))
def test_cached_ids_equal_the_library(text):
    got = np.frombuffer(encoder(default_path()).ids(text), "<u4").tolist()
    assert got == TOK.encode(text, add_special_tokens=False).ids


def brute_bins(items, cap):
    """Fewest bins, by trying every placement."""
    best = len(items)
    items = sorted(items, reverse=True)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(items):
            best = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= items[k]:
                go(k + 1, rooms[:i] + [rooms[i] - items[k]] + rooms[i + 1:])
        go(k + 1, rooms + [cap - items[k]])

    go(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 19), max_size=9))
def test_bin_completion_is_valid_and_near_the_optimum(items):
    hist = {n: items.count(n) for n in set(items)}
    patterns, proven = bin_completion(hist, 20)
    packed = [n for p, t in patterns for n in p * t]
    assert sorted(packed) == sorted(items)
    assert all(sum(p) <= 20 and t > 0 for p, t in patterns)
    bins, best = sum(t for _, t in patterns), brute_bins(items, 20)
    assert best >= lower_bound(hist, 20) and (not proven or bins == best) and bins <= best + 1


def check_packing(rows, texts, cap=1024):
    by_seq, by_doc = {}, {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for spans in by_seq.values():
        at = 0
        for off, n in sorted(spans):
            assert off == at
            at += n
        assert at <= cap
    for i, t in texts.items():
        ids = np.array(TOK.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        pieces = sorted(by_doc[i], key=lambda r: r["piece"])
        assert len(pieces) == -(-len(ids) // cap) and all(r["length"] == cap for r in pieces[1:])
        at = 0
        for k, r in enumerate(pieces):
            part = ids[at:at + r["length"]].tobytes()
            assert r["piece"] == k and r["start"] == at and r["ids_crc32"] == zlib.crc32(part) and bytes(r["ids"]) == part
            at += r["length"]
        assert at == len(ids)
    return len(by_seq)


def test_pieces_places_and_round_trip(spark):
    texts = {i: "lorem ipsum " * (i * 7 % 900) for i in range(60)} | {60: "", 61: None, 62: "x" * 30_000, 63: "<|endoftext|>"}
    df = spark.createDataFrame(list(texts.items()), SCHEMA).selectExpr("*", "1 as length", "'x' as uid", "2 as `g`")
    rows = pack_documents(df).collect()
    n = check_packing(rows, texts)
    total = sum(r["length"] for r in rows)
    assert n <= -(-total // 1024) + 1


def test_repeated_rows_and_null_ids_are_all_packed(spark):
    df = spark.createDataFrame([(1, "a b c")] * 5 + [(None, None)] * 2, SCHEMA)
    rows = pack_documents(df).collect()
    assert len(rows) == 7 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 7
    assert {r["sequence_id"] for r in rows} == {0}


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_packs_the_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = pack_documents(docs).collect()
    n = check_packing(rows, texts)
    lengths = [r["length"] for r in rows]
    assert n <= lower_bound({k: lengths.count(k) for k in set(lengths)}, 1024) + 1
