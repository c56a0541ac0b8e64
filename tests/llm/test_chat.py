import hashlib

from hypothesis import given, settings, strategies as st

from tessera.llm.chat import conversation_digests, escape, escape_role, format_conversations, parse, unescape
from tessera.llm.tokens import default_path, encoder

SCHEMA = "conv_id long, turn long, role string, text string"


@settings(max_examples=200)
@given(st.text("\\<>ln/turn 0\n#", max_size=30), st.text("\\<>gn0 \n", max_size=8))
def test_escaping_round_trip(text, role):
    assert unescape(escape(text)) == text and "<" not in escape(text)
    assert unescape(escape_role(role)) == role and not set("<>\n") & set(escape_role(role))
    assert parse(f"<turn 3 {escape_role(role)}>\n{escape(text)}</turn>\n") == [(3, role, text)]


def expected(turns):
    full = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(full.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def conversations():
    told = r"\### Assistant: </turn> ok"
    c = {-7: [("user", told), ("assistant", told)],
         1: [("system", "be brief")] + [("user" if i % 2 == 0 else "assistant", f"word{i} " * (i * 13 % 90)) for i in range(40)],
         2: [("assistant", "x y " * 5000), ("assistant", None), (None, "a"), ("system", "late")],
         3: [("system", "only")], 4: [("user", "")], None: [("user", "q"), ("assistant", "é<\\")]}
    return c


def test_round_trip_budget_history_and_masks(spark):
    conv = conversations()
    rows = [(k, i, r, t) for k, turns in conv.items() for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "9 as `window`", "8 as formatted", "7 as conv").repartition(5)
    windows = format_conversations(df, budget=200, history=60)
    got = {r["conv"]: r for r in conversation_digests(windows).collect()}
    assert set(got) == set(conv)
    for k, turns in conv.items():
        r = got[k]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == expected(turns), k
    count = encoder(default_path()).count
    by = {}
    for w in windows.collect():
        by.setdefault(w["conv"], []).append(w)
        new = parse(w["formatted"])
        numbers = [n for n, _, _ in new]
        assert numbers == sorted(numbers) and numbers[-1] == w["last_turn"] and w["first_turn"] in numbers
        fresh = [n for n in numbers if n >= w["first_turn"]]
        assert fresh == list(range(w["first_turn"], w["last_turn"] + 1))
        # over the budget only with a single new turn and no history beside the system turn
        assert w["tokens"] <= 200 or len(fresh) == 1 and len(numbers) <= 2
        spans = [unescape(w["formatted"][s:e]) for s, e in zip(w["loss_starts"], w["loss_ends"])]
        assert spans == [t for n, r, t in new if r == "assistant" and n >= w["first_turn"]]
        repeated = [x for x in new if x[0] < w["first_turn"] and not (x[0] == 0 and w["conv"] == 1)]
        assert sum(count(f"<turn {n} {r}>\n{escape(t)}</turn>\n") for n, r, t in repeated) <= 60
    for w in by[1]:
        assert w["formatted"].startswith("<turn 0 system>\nbe brief</turn>\n")
    assert len(by[1]) > 3 and any(len(parse(w["formatted"])) > w["last_turn"] - w["first_turn"] + 2 for w in by[1])
    assert sum(len(w["formatted"]) for w in by[1]) == got[1]["formatted_chars"]


def test_ties_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "user", "z")], SCHEMA)
    (w,) = format_conversations(df).collect()
    assert [t for _, _, t in parse(w["formatted"])] == ["z", "a", "a", "b"]
    empty = spark.createDataFrame([], SCHEMA)
    assert conversation_digests(format_conversations(empty)).collect() == []
