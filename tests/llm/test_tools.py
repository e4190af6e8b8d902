"""Tool calls: levels of deep and odd graphs by brute force, whole and long texts."""

from __future__ import annotations

import json
import random
import time

from cartpulse.llm import tools

CALLS = "conv_id bigint, turn bigint, call_id string, name string, arguments string, depends_on array<string>"
RESULTS = "conv_id bigint, call_id string, turn bigint, content string"


def levels_by_hand(calls):
    deps = {}
    for conv, _, call, _, _, needs in calls:
        if call:
            deps.setdefault((conv, call), set()).update((conv, n) for n in needs or [])
    deps = {key: {n for n in needs if n in deps} for key, needs in deps.items()}
    found = {}
    while True:
        new = {k: 1 + max((found[n] for n in needs), default=-1) for k, needs in deps.items() if k not in found and all(n in found for n in needs)}
        if not new:
            return {k: found.get(k) for k in deps}
        found |= new


def test_levels_by_brute_force(frame):
    draw = random.Random(4)
    calls = []
    for conv in (1, 2, None):
        names = [f"c{i}" for i in range(30)]
        for i, name in enumerate(names):
            later = draw.random() < 0.05  # may close a cycle
            pool = names if later else names[:i]
            needs = draw.sample(pool, min(len(pool), draw.choice((0, 1, 1, 1, 1, 2, 3)))) + draw.choice(([], [], ["gone"]))
            calls.append((conv, i, name, "search", "{}", needs))
        calls.append((conv, 99, "c3", "search", "{}", ["c1"]))  # a repeated identifier adds its own
    cycle = {"p": ["q"], "q": ["p"], "r": ["q"], "s": ["r", "t"], "t": [], "u": ["u"]}
    calls += [(4, i, name, "search", "{}", needs) for i, (name, needs) in enumerate(cycle.items())]
    calls += [(3, i, i and f"d{i}" or "", "search", "{}", None) for i in range(3)]
    got = {(r.conv_id, r.call_id): r.level for r in tools.levels(frame(CALLS, calls)).collect()}
    want = levels_by_hand(calls)
    assert got == want and None in want.values() and max(level or 0 for level in want.values()) > 4


def test_a_chain_of_200_calls(frame):
    calls = [(1, i, f"c{i}", "search", "{}", [f"c{i - 1}"] if i else []) for i in range(200)]
    started = time.monotonic()
    got = {r.call_id: r.level for r in tools.levels(frame(CALLS, calls)).collect()}
    assert got == {f"c{i}": i for i in range(200)}
    assert time.monotonic() - started < 30


def test_whole_texts_and_repeated_identifiers(frame):
    odd = 'é "quoted" \\ \n\t\x01 \U0001f600 ' + "x" * 1_000_000
    turns = [(1, 0, "user", "start"), (1, 1, "assistant", odd + "y" * 4), (1, 2, "user", odd), (1, 1, "assistant", "again"), (1, 3, "assistant", None), (2, 1, "assistant", ""), (None, 5, "assistant", "b")]
    rows = tools.linked_calls(frame("conv_id bigint, turn int, role string, text string", turns)).collect()
    first = next(r for r in rows if r.conv_id == 1 and r.turn == 1 and len(r.canonical) > 1_000_000)
    told = json.loads(first.canonical)
    assert told["result"] == odd and "identifier is repeated" in first.problems
    assert all(json.loads(r.canonical)["id"] == f"call-{r.turn}" for r in rows) and len(rows) == 5
