import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratum.llm import chat as C

PIECES = st.lists(st.sampled_from([*C.CONTROL, "<", "|", "/", "s>", "[", "INST]", "\\", "turn|>", "\n", "end", "é", " "]), max_size=14).map("".join)


@settings(max_examples=400, deadline=None)
@given(PIECES)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    assert C.unescape(C.escape(text)) == text
    assert not any(c in C.escape(text) for c in C.CONTROL)
    assert C._unrole(C._role(text)) == text and "\n" not in C._role(text)


TURNS = st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a\nb", ""]), PIECES), min_size=1, max_size=12)


@settings(max_examples=150, deadline=None)
@given(st.lists(TURNS, min_size=1, max_size=4), st.integers(1, 60))
def test_windows_hold_each_turn_once_and_context_is_masked(conversations, budget):
    rows = [(c, r, t) for c, turns in enumerate(conversations) for r, t in turns]
    made = list(C.windows(iter(rows), budget=budget, history_turns=2, history_tokens=20))
    for c, turns in enumerate(conversations):
        own = [w for w in made if w["conv_id"] == c]
        assert [w["window"] for w in own] == list(range(len(own)))
        new, loss, seen = [], [], []
        for w in own:
            read = C.read_window(w["formatted"])
            context, fresh = read[:w["n_context"]], read[w["n_context"]:]
            assert fresh
            if seen:  # the system turn, then the last turns before the window
                head = context[:1] if turns[0][0] == "system" else []
                tail = context[len(head):]
                assert head in ([], [turns[0]]) and tail == seen[len(seen) - len(tail):] and len(tail) <= 2
            assert len(fresh) == 1 or w["n_tokens"] <= budget
            seen += fresh
            new += fresh
            loss += [C.unescape(w["formatted"][s["lo"]:s["hi"]]) for s in w["loss"]]
        assert new == turns
        assert loss == [t for r, t in turns if r == "assistant"]


def test_digests_of_awkward_tables(spark):
    rng = np.random.default_rng(0)
    rows = [(1, 0, "system", "be <|brief|>"), (1, 1, "user", None), (1, 2, "assistant", "x " * 3000), (1, 2, "assistant", "x " * 3000),
            (1, 2, "assistant", "a"), (1, None, "user", "first"), (None, 1, None, "no role"), (None, 0, "assistant", "[INST]"), (2, 0, "assistant", "")]
    rows += [(3, k, ("user", "assistant")[k % 2], " ".join(map(str, rng.integers(0, 9, 50)))) for k in range(400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "'x' AS window", "'x' AS formatted", "'x' AS loss")
    made = C.format_conversations(df, budget=300)
    got = {r.conv_id: r for r in C.digests(made).collect()}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=order)]
        loss = "".join(t for role, t in turns if role == "assistant")
        r = got[conv]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[3].n_windows > 50 and got.keys() == {1, 2, 3, None}
    assert sum(len(r.formatted) for r in made.collect()) == sum(r.formatted_chars for r in got.values())
    assert C.digests(C.format_conversations(df.where("false"))).count() == 0


@pytest.mark.parametrize("budget, history_turns, history_tokens, partitions", [(60, 3, 25, 9), (200, 4, 80, 23), (7, 0, 0, 5), (100_000, 2, 9, 6)])
def test_a_conversation_over_many_partitions_has_the_windows_of_a_plain_pass(spark, budget, history_turns, history_tokens, partitions):
    rng = np.random.default_rng(budget)
    rows = [(7, k, ("user", "assistant")[k % 2] if k else "system", " ".join(["w"] * int(rng.integers(0, 30)))) for k in range(900)]
    rows += [(None, k, ("user", "assistant")[k % 2], f"x {k} " * int(rng.integers(0, 9))) for k in range(300)]
    rows += [(2**60 + c, k, "assistant", "é " * int(rng.integers(0, 200))) for c in range(60) for k in range(int(rng.integers(1, 7)))]
    df = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "conv_id long, turn long, role string, text string")
    made = C.format_conversations(df, budget, history_turns, history_tokens, partitions=partitions)
    got = sorted(map(tuple, made.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    plain = C.windows(((c, r, t) for c, _, r, t in rows), budget, history_turns, history_tokens)
    assert got == [(w["conv_id"], w["window"], w["formatted"], [(s["lo"], s["hi"]) for s in w["loss"]], w["n_context"], w["n_tokens"]) for w in plain]


def test_equal_rows_of_one_conversation_spread_over_partitions(spark):
    df = spark.range(30_000).selectExpr("CAST(NULL AS long) AS conv_id", "CAST(NULL AS long) AS turn", "'assistant' AS role", "'a b c' AS text")
    ordered = C._ordered(df, C.count_tokens, 8)
    assert ordered.groupBy("part").count().agg({"count": "max"}).first()[0] < 8_000
    r = C.digests(C.format_conversations(df, partitions=8)).first()
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (30_000, 150_000, hashlib.sha256(b"a b c" * 30_000).hexdigest())
