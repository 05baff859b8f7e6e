"""Tool-call links: repeated, early, missing and depending calls, schema errors, the query against its SQL."""

import json
import random
from collections import Counter

import duckdb
from tidemark.llm import chat

MESSAGES = "conv_id long, turn long, role string, text string"
ADD = {"add": {"x": ("integer", True), "y": ("integer", True), "note": ("string", False, 5)}}


def call(i, name, **arguments):
    return {"id": i, "name": name, "arguments": arguments}


def say(*calls):
    return json.dumps({"tool_calls": list(calls)})


def answer(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


def linked(spark, rows, schemas=ADD):
    messages = spark.createDataFrame(rows, MESSAGES)
    return chat.link(chat.calls_of_json(messages), chat.results_of_json(messages), schemas).collect()


def test_links_errors_and_json(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", say(call("a", "add", y=2, x=1), call("b", "add", x="no"))), (1, 2, "tool", answer("b", "late")), (1, 3, "tool", answer("a", "3")),
        (2, 5, "assistant", say(call("a", "none"))), (2, 1, "tool", answer("a", "early")), (2, 9, "tool", answer("z", "lost")), (3, 0, "assistant", "plain text"), (3, 1, "assistant", None),
        (4, 0, "assistant", say(call("a", "add", x=1, y=1, q=0, note="too long"))), (4, 1, "assistant", say(call("n", "add", x=1, y=1, note=None))),
        (None, 0, "assistant", say(call("n", "add", x=1, y=1))), (5, 0, "assistant", '{"tool_calls": [{"id": null, "name": "add", "arguments": [1]}]}'), (5, 1, "tool", '{"content": "x"}'),
    ]
    got = {(r.conv_id, r.call_id, r.status): r for r in linked(spark, rows)}
    assert {k: (r.errors, r.at_turn, r.step) for k, r in got.items()} == {
        (1, "a", "linked"): ("", 1, 0), (1, "b", "linked"): ("x: not integer; y: missing", 1, 0), (2, "a", "moved"): ("no such tool", 5, 0), (2, "z", "no_call"): ("", 9, 0),
        (4, "a", "no_result"): ("note: longer than 5; unknown: q", 0, 0), (4, "n", "no_result"): ("", 1, 0), (None, "n", "no_result"): ("", 0, 0),
        (5, None, "no_result"): ("arguments: not an object", 0, 0), (5, None, "no_call"): ("", 1, 0),
    }
    assert got[1, "a", "linked"].json == '{"call":{"arguments":{"x":1,"y":2},"id":"a","name":"add"},"result":{"content":"3","id":"a"}}'


def test_repeated_calls_and_results_are_all_kept(spark):
    one, other = say(call("a", "add", x=1, y=1)), say(call("a", "add", x=2, y=2))
    rows = [(1, 0, "assistant", one), (1, 0, "assistant", one), (1, 4, "assistant", other), (1, 5, "tool", answer("a", "2")), (1, 6, "tool", answer("a", "4")), (1, 6, "tool", answer("a", "4"))]
    got = sorted((r.status, r.at_turn, r.n_calls, r.n_results, json.loads(r.json)) for r in linked(spark, rows))
    result = lambda c: {"content": c, "id": "a"}
    assert got == [
        ("linked", 0, 3, 3, {"call": call("a", "add", x=1, y=1), "result": result("2")}),
        ("repeated_call", 4, 3, 3, {"call": call("a", "add", x=2, y=2), "result": None}),
        ("repeated_result", 6, 3, 3, {"call": None, "result": result("4")}),
    ]


def test_order_follows_references(spark):
    """Every call stands behind what it refers to; cycles say so and end the search."""
    rng = random.Random(51)
    rows, wanted = [], {}
    for conv in range(5):
        order = rng.sample(range(7), 7)  # call i refers to some of the calls before it, and is logged at a turn of its own
        for i in range(7):
            refs = [f"c{j}" for j in rng.sample(range(i), rng.randint(0, min(i, 3)))]
            wanted[conv, f"c{i}"] = refs
            rows.append((conv, order[i], "assistant", say(call(f"c{i}", "add", x=1, y=1, uses=refs))))
    rows += [(50, 0, "assistant", say(call("p", "add", x="q"))), (50, 1, "assistant", say(call("q", "add", x="p"))), (50, 2, "assistant", say(call("own", "add", x="own"))), (50, 3, "assistant", say(call("r", "add", x="q")))]
    got = {(r.conv_id, r.call_id): r for r in linked(spark, rows)}
    place = {k: (r.at_turn, r.step) for k, r in got.items()}
    assert all(place[conv, ref] < place[conv, c] for (conv, c), refs in wanted.items() for ref in refs)
    in_order = [k for k, refs in wanted.items() if not refs]
    assert all(got[k].step == 0 for k in in_order)
    assert [("depends on itself" in got[50, c].errors) for c in ("p", "q", "own", "r")] == [True, True, False, False]


EDGES = "conv_id long, call_id string, turn long, ref string, ref_turn long"


def places_of(spark, graphs):
    """By :func:`chat.moves` and by brute force, of {conversation: (turn of each call, its references)}."""
    rows = [(conv, f"c{i}", turns[i], f"c{j}", turns[j]) for conv, (turns, refs) in graphs.items() for i in refs for j in refs[i]]
    got = {(r.conv_id, r.call_id): (r.place.t, r.place.s) for r in chat.moves(spark.createDataFrame(rows, EDGES)).collect()}
    want = {}
    for conv, (turns, refs) in graphs.items():
        place = [(t, 0) for t in turns]
        for _ in range(2 * len(turns) ** 2):
            place = [max([(turns[i], 0), *((place[j][0], place[j][1] + 1) for j in refs.get(i, []))]) for i in range(len(turns))]
        endless = lambda p: (p[0], chat.ENDLESS if p[1] > len(turns) else p[1])
        want |= {(conv, f"c{i}"): endless(place[i]) for i in refs if refs[i]}
    return got, want


def test_places_are_the_longest_ways(spark):
    """Random references: none, few or many cycles, ties of turns, many ways between the same calls."""
    rng = random.Random(12)
    graphs = {}
    for conv in range(60):
        n = rng.randint(3, 14)
        turns = [rng.randrange(n) for _ in range(n)]
        acyclic = rng.random() < 0.5
        refs = {i: rng.sample([j for j in range(i if acyclic else n) if j != i], min(rng.randint(0, 3), i if acyclic else n - 1)) for i in range(n)}
        if any(turns[j] >= turns[i] for i in refs for j in refs[i]):
            graphs[conv] = turns, refs
    got, want = places_of(spark, graphs)
    assert len(graphs) > 40 and got == want and 20 < sum(s == chat.ENDLESS for _, s in want.values()) < len(want) - 100


def test_a_chain_of_a_thousand_takes_few_rounds(spark, monkeypatch):
    """One conversation: each call refers to the next one, to the next but one and to the first of a cycle at its end, or not."""
    wrote = []
    monkeypatch.setattr(chat, "materialize", lambda df, do=chat.materialize: (wrote.append(1), do(df))[1])
    n = 1000
    rows = [(1, f"c{i:04}", i, f"c{j:04}", j) for i in range(n - 1) for j in {i + 1, min(i + 2, n - 1)}]
    rows += [(2, f"c{i:04}", i, f"c{(i + 1) % n:04}", (i + 1) % n) for i in range(n)] + [(3, f"c{i:04}", i, f"c{i - 1:04}", i - 1) for i in range(1, n)]
    got = {(r.conv_id, r.call_id): (r.place.t, r.place.s) for r in chat.moves(spark.createDataFrame(rows, EDGES)).collect()}
    want = {(1, f"c{i:04}"): (n - 1, n - 1 - i) for i in range(n - 1)} | {(2, f"c{i:04}"): (n - 1, chat.ENDLESS) for i in range(n)}
    assert got == want and len(wrote) < 60


def test_repeated_calls_stand_at_their_own_turn(spark):
    """A later call of the same identifier isn't set before its turn, because the first one had to move."""
    rows = [(1, 0, "assistant", say(call("a", "add", x="b"))), (1, 3, "assistant", say(call("b", "add", x=1))), (1, 9, "assistant", say(call("a", "add", x=2)))]
    assert sorted((r.call_id, r.status, r.at_turn, r.step) for r in linked(spark, rows)) == [("a", "no_result", 3, 1), ("a", "repeated_call", 9, 0), ("b", "no_result", 3, 0)]


def test_empty(spark):
    none = spark.createDataFrame([], MESSAGES)
    assert chat.link(chat.calls_of_turns(none), chat.results_of_turns(none), chat.REPLY, chat.other_turns(none)).count() == 0


def test_query(spark, tmp_path):
    """All rows of the table are in the result, repeated, null and empty ones too."""
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", 'q "1"\n\\'), (1, 2, "assistant", "a 1"), (1, 3, "user", "q 2 é"), (2, 0, "user", ""), (2, 1, "assistant", None), (2, 2, "user", None),
            (3, 0, "assistant", "lost"), (3, 5, None, "x"), (4, 0, "user", "same"), (4, 0, "user", "same"), (4, 0, "user", "other"), (4, 1, "assistant", "b"), (4, 1, "assistant", "a"), (5, 0, "user", "x" * 301)]
    folder = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame(rows, MESSAGES).write.parquet(folder)
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{folder}/*.parquet'")
    columns = chat._COLUMNS
    got = Counter(tuple(r) for r in chat.op1_chat_tool_links(spark, str(tmp_path)).select(columns).collect())
    assert got == Counter(con.sql(chat.ORACLE).select(*columns).fetchall()) and sum(got.values()) == 11
