import itertools
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from cohortloom.llm.canonical import BKTree, Index, edit_distance, map_columns, map_values

REF = [
    ("C1", "cell", "Granaryar-97", "TS001"), ("C2", "cell", "Granaryar-57", None), ("C3", "cell", "HOVJAS-3", "BS009"), ("C4", "cell", "dendritic cell", "antigen presenting DC"), ("D1", "disease", "renal sarcoma", "RESD"),
    ("D2", "disease", "hepatic fibrosis", "HEFX|fibrosis of the liver"), ("D3", "disease", "thyroid carcinoma", None),
]
SCHEMA = "ref_id string, vocab string, preferred_name string, synonyms string"
words = st.text("abc", max_size=6)


@settings(max_examples=300, deadline=None)
@given(words, words, words)
def test_metric(a, b, c):
    assert (edit_distance(a, b) == 0) == (a == b) and edit_distance(a, b) == edit_distance(b, a)
    assert edit_distance(a, c) <= edit_distance(a, b) + edit_distance(b, c)


def test_swaps_count_once():
    assert edit_distance("ab", "ba") == 1 and edit_distance("ca", "abc") == 2 and edit_distance("", "abc") == 3


@settings(max_examples=60, deadline=None)
@given(st.lists(words, min_size=1, max_size=40), words, st.integers(0, 3))
def test_tree_returns_every_key_within_the_threshold(keys, text, threshold):
    assert BKTree(keys).search(text, threshold) == sorted((d, k) for k in set(keys) if (d := edit_distance(text, k)) <= threshold)


def best(vocab, value):
    hit = Index(REF, {"renal": "kidney", "hepatic": "liver", "thyroid": "thyroid gland"}).best(vocab, value)
    return hit and hit[2]


def test_readings():
    for value in ("Granaryar-97", "granaryar 97", "GRANARYAR97 (passage 12)", "parental Granrayar-97", "Granaryar-97, kidney", "Granaryar-97 KYQT-KO", "cell line: Granaryar–97*", "ts001", "Granaryar-97 skin cell line", "C1"):
        assert best("cell", value) == "C1", value
    for value in ("Granaryar-197", "Granaryar-9", "Gilvelyar-97", "TS002", "mixed culture", "", "   ", "???", "x" * 20_000):
        assert best("cell", value) is None, value[:30]
    assert best("cell", "human dendriitic cells") == "C4"
    for value in ("Sarcoma (renal)", "sarcoma of kidney", "sarcoma, kidney", "stage III renal sarcoma", "relapsed rneal sarcoma", "RESD: renal sarcoma", "renal_sarcoma", "renal sarcoma; ZUVN7 loss of function", "Reanl sarcomma"):
        assert best("disease", value) == "D1", value
    for value in ("renal fibrosis", "hepatic sarcoma patient", "healthy", "thyroid necrosis"):
        assert best("disease", value) is None, value
    assert best("disease", "fibrosis of liver") == "D2" and best("disease", "carcinoma of the thyroid gland") == "D3"


def test_table_edges_and_shards(spark):
    ref = spark.createDataFrame([*REF, (None, "cell", "Lost-1", None)], SCHEMA)
    df = spark.createDataFrame([(1, "Granaryar-97", "renal sarcoma", "x"), (2, None, None, None), (3, "", "nothing", "y"), (3, "", "nothing", "y")], "id long, cell string, term string, value string")
    one = map_columns(df, "id", {"cell": "cell", "term": "disease"}, ref)
    rows = sorted((r.id, r.field_name, r.ref_id or "unmatched") for r in one.collect())
    assert rows == [(1, "cell", "C1"), (1, "term", "D1"), (3, "cell", "unmatched"), (3, "cell", "unmatched"), (3, "term", "unmatched"), (3, "term", "unmatched")]
    assert map_columns(df.limit(0), "id", {"cell": "cell"}, ref).count() == 0
    assert [r.ref_id for r in map_columns(df.limit(1), "id", {"cell": "cell"}, ref.limit(0)).collect()] == [None]


def test_shards_merge_to_the_same_winners(spark):
    rnd = random.Random(5)
    names = ["".join(rnd.choice("abcdefg") for _ in range(8)) + f"-{rnd.randint(1, 9)}" for _ in range(60)]
    ref = spark.createDataFrame([(f"R{i:03d}", "cell", n, None) for i, n in enumerate(names)], SCHEMA)
    typed = [n if rnd.random() < 0.5 else n[:2] + n[3] + n[2] + n[4:] for n in names] + ["zzzzzzzz-1"]
    values = spark.createDataFrame([("cell", v) for v in typed], "vocab string, value string")
    whole = {r.value: r.ref_id for r in map_values(values, ref).collect()}
    cut = {r.value: r.ref_id for r in map_values(values, ref, shard_rows=15).collect()}
    assert whole == cut and whole["zzzzzzzz-1"] is None


def test_all_learned_organs_are_used(spark):
    """More adjectives than were once kept; each entry has a vocabulary of its own, so the trees are small."""
    names = ["".join(x) for x in itertools.islice(itertools.product("bcdfghklmnprtvz", repeat=4), 10_060)]
    ref = spark.createDataFrame([(f"R{x}", x, f"{x}ic sarcoma", f"sarcoma of the {x}um") for x in names], "ref_id string, vocab string, preferred_name string, synonyms string")
    values = spark.createDataFrame([(x, f"{x}um sarcoma") for x in names], "vocab string, value string")
    got = map_values(values, ref).collect()
    assert len(got) == len(names) and all(r.ref_id == f"R{r.vocab}" and r.distance == 0 for r in got)
