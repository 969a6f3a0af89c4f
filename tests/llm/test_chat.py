import random

import pytest

from pitlane.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, pos string, h1 string, segment string"


def frame(spark, convs, extra=()):
    rows = [(c, t, r, x, "k", "k", "k") for c, turns in convs.items() for t, (r, x) in enumerate(turns)]
    return spark.createDataFrame(rows + list(extra), SCHEMA)


def plain(convs):
    """conv -> (n_turns, copies, snapshots) by comparing whole lists."""
    whole = {c: tuple(t) for c, t in convs.items() if t}
    out = {}
    for c, t in whole.items():
        if any(len(o) > len(t) and o[:len(t)] == t for o in whole.values()):
            continue
        if any(o == t and d < c for d, o in whole.items()):
            continue
        out[c] = (len(t), sum(o == t for o in whole.values()), sum(len(o) < len(t) and t[:len(o)] == o for o in whole.values()))
    return out


def test_matches_plain_and_renders_all_turns(spark):
    rng = random.Random(4)
    convs, i = {}, 0
    for _ in range(40):
        full = [(rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "x y"])) for _ in range(rng.randint(1, 7))]
        for n in rng.sample(range(1, len(full) + 1), rng.randint(1, len(full))):
            convs[i] = full[:n]
            i += 1
    convs[1000] = [("user", "t" * 50_000)] + [("user", str(k)) for k in range(2500)]
    extra = [(None, 0, "user", "no id", "k", "k", "k"), (0, 0, *convs[0][0], "k", "k", "k")]  # no id; a repeated row
    got = C.format_chats(frame(spark, convs, extra)).collect()
    want = plain(convs)
    assert {r.conv_id: (r.n_turns, r.copies, r.snapshots) for r in got} == want
    text = {}
    for r in sorted(got, key=lambda r: (r.conv_id, r.segment)):
        text[r.conv_id] = text.get(r.conv_id, "") + r.text
    for c in want:
        assert text[c] == "".join(f"<|{r or ''}|>\n{x or ''}\n<|end|>\n" for r, x in convs[c])
    assert max(r.segment for r in got if r.conv_id == 1000) == 2


def test_order_ties_nulls_and_gaps(spark):
    rows = [(1, 9, "b", "2"), (1, None, "z", "0"), (1, 3, "b", "1"), (1, 3, "a", "1"), (2, 0, "z", "0"), (2, 5, "a", "1")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = C.format_chats(df).collect()
    assert [(r.conv_id, r.n_turns, r.snapshots) for r in got] == [(1, 4, 1)]
    assert got[0].text.index("z") < got[0].text.index("a")


def test_empty_and_role_matters(spark):
    assert C.format_chats(frame(spark, {})).count() == 0
    assert C.format_chats(frame(spark, {1: [("user", "x")], 2: [("system", "x"), ("user", "y")]})).count() == 2


@pytest.mark.parametrize("step", ["ordered", "all"])
def test_plans_stay_in_the_engine(spark, step):
    df = frame(spark, {1: [("user", "x")]})
    out = C.ordered_turns(df) if step == "ordered" else C.format_chats(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))
