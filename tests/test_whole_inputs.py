"""Queries over the event log against a plain walk over every event, none left out."""

from collections import Counter

import pandas as pd
from conftest import SMALL

from cohortloom.operators.runs import TERMINAL
from cohortloom.plans.batch_queries import cache_files, run_states, scheduler_states

STATES = {"signup": "queued", "view": "running", "click": "running", "purchase": "completed", "error": "failed"}


def events():
    e = pd.read_parquet(f"{SMALL}/events.parquet").sort_values(["ts", "event_id"])
    e["state"] = ["collected" if t == "purchase" and i % 4 == 0 else STATES[t] for t, i in zip(e.event_type, e.event_id)]
    return e


def test_states_of_all_events(spark):
    e = events()
    assert {r.state: r.n for r in scheduler_states(spark, SMALL).collect()} == Counter(e.state)
    want, n = {}, Counter(e.user_id)
    for user, s in zip(e.user_id, e.state):
        old = want.get(user)
        if not (old == "collected" and s == "completed" or old in TERMINAL and s not in TERMINAL):
            want[user] = s
    assert {r.user_id: (r.state, r.n_events) for r in run_states(spark, SMALL).collect()} == {u: (s, n[u]) for u, s in want.items()}


def test_cache_over_all_events(spark):
    e = events()
    want = {f"{u}:{t}": p for u, t, p in zip(e.user_id, e.event_type, e.props)}
    got = cache_files(spark, SMALL).collect()
    assert len(got) == len(want) and {r.key: r.value for r in got} == want
