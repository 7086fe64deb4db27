import random

from cohortloom.llm.consensus import consensus, normal_label
from pyspark.sql import functions as F

LABELS = ["A", "B", "both", "unclear"]
SCHEMA = "item long, annotator string, choice string, at int, vote_id long, label string, m string"


def votes(n=600, seed=3):
    """Good, middling, biased, random and label-swapping annotators over known truths."""
    rnd = random.Random(seed)
    truth = {i: rnd.choices(LABELS, [4, 3, 2, 1])[0] for i in range(n)}
    skill = {"good": 0.95, "fair": 0.8, "poor": 0.5, "other": 0.75, "swap": 0.9, "spam_a": 0.0, "random": 0.0}
    rows, k = [], 0
    for i, t in truth.items():
        for name, s in skill.items():
            if rnd.random() < 0.75:
                c = t if rnd.random() < s else ("A" if name == "spam_a" else rnd.choice(LABELS))
                if name == "swap":
                    c = {"A": "B", "B": "A"}.get(c, c)
                k += 1
                rows.append((i, name, c, 1, k, "x", "y"))
    return truth, rows


def test_recovers_truth_and_reliability(spark):
    truth, rows = votes()
    items, people = consensus(spark.createDataFrame(rows, SCHEMA), LABELS)
    got = items.collect()
    right = sum(truth[r.item] == r.choice for r in got) / len(got)
    plain = spark.createDataFrame(rows, SCHEMA).groupBy("item", "choice").count().groupBy("item").agg(F.max_by("choice", F.struct("count", "choice")).alias("c")).collect()
    assert right > 0.93 and right > sum(truth[r.item] == r.c for r in plain) / len(plain)
    rel = {r.annotator: r.reliability for r in people.collect()}
    assert rel["good"] > rel["fair"] > rel["poor"] > max(rel["spam_a"], rel["random"]) and rel["swap"] > 0.75 and rel["spam_a"] < 0.2
    assert all(0 <= r.posterior <= 1 and (r.agreement is None) == (r.n_votes == 1) for r in got)


def test_joined_steps_agree(spark):
    """Beyond the annotator bound the same model runs as joins."""
    truth, rows = votes(150)
    rows = [r for r in rows if r[1] != "swap"]
    a = {r.item: r.choice for r in consensus(spark.createDataFrame(rows, SCHEMA), LABELS)[0].collect()}
    joined, people = consensus(spark.createDataFrame(rows, SCHEMA), LABELS, max_annotators=2, steps=12)
    b = {r.item: r.choice for r in joined.collect()}
    assert a.keys() == b.keys() and sum(a[k] == b[k] for k in a) > 0.97 * len(a)
    assert people.count() == 6


def test_latest_valid_vote_counts(spark):
    rows = [
        (1, "p", "A", 1, 1, "", ""), (1, "p", "(B)", 3, 2, "", ""), (1, "p", "skip", 9, 3, "", ""), (1, "p", "B.", 3, 4, "", ""), (2, "p", None, 1, 5, "", ""), (2, None, "A", 1, 6, "", ""), (None, "p", "A", 1, 7, "", ""),
        (3, "q", "Series both", None, 8, "", ""), (3, "q", "Series both", None, 8, "", ""),
    ]
    items, _ = consensus(spark.createDataFrame(rows, SCHEMA), LABELS)
    assert {r.item: (r.choice, r.n_votes) for r in items.collect()} == {1: ("B", 1), 3: ("both", 1)}


def test_spelling_and_empty_tables(spark):
    df = spark.createDataFrame([(x,) for x in (" A", "series a", '"both"', "UNCLEAR ", "ERROR", "n/a", "", None, "ab", "A" * 100_000)], "c string")
    assert [r[0] for r in df.select(normal_label(F.col("c"), LABELS)).collect()] == ["A", "A", "both", "unclear", None, None, None, None, None, None]
    items, people = consensus(df.limit(0).selectExpr("1L as item", "c as annotator", "c as choice", "1 as at", "1L as vote_id"), LABELS)
    assert items.count() == 0 and people.count() == 0


def test_both_paths_give_the_same_results(spark):
    """Exchanged label names are seen, and the steps end, beyond the annotator bound too."""
    _, rows = votes(300)
    df = spark.createDataFrame(rows, SCHEMA)
    (items, people), (joined_items, joined_people) = consensus(df, LABELS), consensus(df, LABELS, max_annotators=0)
    assert joined_items.columns == items.columns and joined_people.columns == people.columns
    a, b = ({r.item: r for r in x.collect()} for x in (items, joined_items))
    assert {i: (r.choice, r.n_votes, r.agreement) for i, r in a.items()} == {i: (r.choice, r.n_votes, r.agreement) for i, r in b.items()}
    assert all(abs(r.posterior - b[i].posterior) < 1e-6 for i, r in a.items())
    a, b = ({r.annotator: r for r in x.collect()} for x in (people, joined_people))
    assert a.keys() == b.keys() and a["swap"].reliability > 0.75
    for x, r in a.items():
        assert r.n_votes == b[x].n_votes and max(abs(u - v) for u, v in zip([r.reliability, *r.guesses], [b[x].reliability, *b[x].guesses])) < 1e-6


def test_assignment_equals_all_permutations():
    import itertools

    import numpy as np

    from cohortloom.llm.consensus import best_match, renamings

    rng = np.random.default_rng(3)
    for k in (1, 2, 3, 4, 5, 6):
        for _ in range(20):
            g = rng.integers(0, 9, (k, k)).astype(float)
            best = best_match(g)
            assert sorted(best) == list(range(k))
            assert sum(g[i, best[i]] for i in range(k)) == max(sum(g[i, p[i]] for i in range(k)) for p in itertools.permutations(range(k)))
    assert best_match(np.ones((4, 4))) == [0, 1, 2, 3]
    # nine labels, two of them exchanged; a handful of votes isn't enough
    table = np.stack([np.eye(9) * 40, np.eye(9)[[1, 0, *range(2, 9)]] * 40, np.eye(9)[[1, 0, *range(2, 9)]] * 0.3])
    names = renamings(table, least_gain=0.1)
    assert names[0].tolist() == list(range(9)) and names[1].tolist() == [1, 0, *range(2, 9)] and names[2].tolist() == list(range(9))
