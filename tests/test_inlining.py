import json

from cohortloom.contracts import FACT_SIGNATURE
from cohortloom.operators.inlining import LEAF, Edge, ElementGraph, find_record, infer_graph, relation_table, shred, shred_record
from cohortloom.plans.nested_facts import fact_graph

FACT = {
    "geo_accession": "GSM1", "series_id": "GSE1", "organism": None,
    "cell_context": {"engineered_modifications": [{"kind": "a", "variant": {"label": "L", "is_wildtype": False}}, None, {"kind": "b"}]},
    "perturbations": [{"agent_normalized": {"id": 900}}, {"agent_normalized": None, "mediated_effect": {"targets": ["X", None, "Y"]}}],
    "extraction": {"ambiguity_flags": "single"},
}
TEXT = json.dumps(FACT)


def test_wrapping_is_looked_through():
    nested = json.dumps({"record_id": 1, "result": TEXT})
    for text in (TEXT, f"```json\n{TEXT}\n```", f"Here {{it}} is: {TEXT} -- end", json.dumps(TEXT), f"[{TEXT}]", nested, "x " + json.dumps(TEXT), json.dumps({"sample_facts": FACT}, indent=2)):
        assert find_record(text, FACT_SIGNATURE) == FACT, text[:30]


def test_cut_off_texts_have_no_record():
    for cut in range(1, len(TEXT), 7):
        assert find_record(TEXT[:cut], FACT_SIGNATURE) is None
    for text in (None, "", "   ", "null", "{}", "I could not read it.", "[1, 2", '{"a": {"geo_accession": 1}}'):
        assert find_record(text, FACT_SIGNATURE) is None


def test_long_broken_text_is_not_quadratic():
    assert find_record("{" * 200_000, FACT_SIGNATURE) is None


def test_rows_ordinals_and_keys(spark):
    rows = shred_record(FACT, fact_graph())
    got = {(r[0], r[4], r[6], r[7].get("kind") or r[7].get("value") or r[7].get("agent_normalized.id")) for r in rows if r[0] != "fact"}
    assert got == {("engineered_modifications", 0, 0, "a"), ("engineered_modifications", 0, 2, "b"), ("perturbations", 0, 0, "900"), ("perturbations", 0, 1, None), ("targets", 1, 0, "X"), ("targets", 1, 2, "Y"), ("ambiguity_flags", 0, 0, "single")}
    by_node = {r[1]: r for r in rows}
    assert all(r[3] is None or by_node[r[3]][0] == r[2] for r in rows)
    assert next(r for r in rows if r[0] == "engineered_modifications")[7]["variant.label"] == "L"


def test_shared_and_recursive_elements_get_relations():
    g = ElementGraph("doc", {"doc": [Edge("a", "person"), Edge("b", "person"), Edge("tree", "node"), Edge("head", "head")], "person": [Edge("name", LEAF)], "head": [Edge("title", LEAF)], "node": [Edge("v", LEAF), Edge("kids", "node", True)]})
    assert g.relations == {"doc", "person", "node"} and g.columns("doc") == ["head.title"]
    deep = {"v": 0}
    for i in range(3000):
        deep = {"v": i, "kids": [deep]}
    rows = shred_record({"a": {"name": "x"}, "b": {"name": "y"}, "tree": deep}, g)
    assert sum(r[0] == "node" for r in rows) == 3001 and [r[5] for r in rows if r[0] == "person"] == ["a", "b"]


def test_tables_with_repeats_nulls_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, TEXT, "x", "y"), (1, TEXT, "x", "y"), (2, None, "x", None), (3, "cut {", None, None)], "fact_id long, raw_output string, node string, relation string")
    rows = shred(df, "fact_id", "raw_output", fact_graph(), FACT_SIGNATURE)
    assert relation_table(rows, "fact_id", fact_graph(), "perturbations").count() == 4
    assert relation_table(rows, "fact_id", fact_graph(), "fact").select("geo_accession").collect()[0][0] == "GSM1"
    assert shred(df.limit(0), "fact_id", "raw_output", fact_graph(), FACT_SIGNATURE).count() == 0


def test_inferred_graph(spark):
    df = spark.createDataFrame([(TEXT,)], "t string")
    g = infer_graph(df, "t", FACT_SIGNATURE, "fact")
    assert "perturbations" in g.relations and "cell_context" not in g.relations
    assert "targets" in g.all_relations() and "ambiguity_flags" not in g.all_relations()  # a single bare value shows no list


def test_deep_and_repeated_wrapping_is_looked_through():
    deep, encoded = FACT, TEXT
    for k in range(40):
        deep = {"r": deep} if k % 2 else [deep]
    for _ in range(6):
        encoded = json.dumps(encoded)
    cases = [json.dumps(deep), encoded, 'As "{x}" or "{" says: ' + json.dumps(TEXT), "So: " + json.dumps(f"[{TEXT}]"), 'A "{\n" and then ' + json.dumps(json.dumps(TEXT)), json.dumps({"a": [json.dumps(deep)]})]
    for text in cases:
        assert find_record(text, FACT_SIGNATURE) == FACT, text[:40]


def test_many_encoded_starts_are_not_quadratic():
    for text in ('"{' * 200_000, '\\"{' * 200_000, '"{' + '\\"{' * 200_000 + "\n", '"{"' * 100_000):
        assert find_record(text, FACT_SIGNATURE) is None
