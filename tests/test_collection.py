"""Literal cases of contracts, enrichment, collection, lookups, bundles and orchestrated runs."""

import json

import pytest
from pyspark.sql import functions as F

from cohortloom.contracts import DESIGN_CONTRACT, FACT_CONTRACT, design_schema, fact_schema
from cohortloom.operators import backend, collection, evaluation, runs, sampling
from cohortloom.operators.contracts_check import import_reviewed
from cohortloom.operators.nested_contract import compile_contract, validate
from cohortloom.sources import bundles, files, lookup
from cohortloom.streaming import resume

FACT = {
    "geo_accession": "GSM1", "series_id": "GSE1", "organism": None, "host_organism": None,
    "cell_context": {
        "cell_type_or_line_raw": "x", "cell_line_cellosaurus_candidate": None, "tissue": None, "tissue_segment": None, "passage_or_state": None, "context_kind": "organoid", "developmental_stage": None, "cell_state": None,
        "subcellular_fraction": None, "engineered_modifications": [{"kind": "other", "label": None, "variant": {"label": "v", "description": None, "is_wildtype": False}}], "co_culture_partners": [], "sort_markers": ["a"],
        "cell_composition_estimates": [{"marker": "m", "proportion": 0.5, "method": None}],
    },
    "disease_state": {"term_raw": None, "mesh_id_candidate": None, "status": "none"},
    "perturbations": [{
        "kind": "small_molecule", "agent_raw": "a", "agent_normalized": {"type": "other", "id_database": None, "id": None, "preferred_name": None, "collection": None}, "dose": {"value_raw": "1", "value_numeric": 1, "unit": None},
        "duration": {"value_raw": None, "value_hours": 2.5, "is_zero_timepoint": False}, "phase": None, "temporal_order": 1, "is_negative_control": False, "mediated_effect": {"kind": "other", "targets": ["T"]},
    }],
    "technical_treatments": [], "patient_metadata": None,
    "extraction": {"schema_version": "stage1.v3", "model": "m", "confidence": 1, "ambiguity_flags": ["missing_dose"], "raw_input_hash": "sha256:" + "0" * 64},
}
DESIGN = {
    "series_id": "GSE12", "design_summary": "ten letters", "design_kind": "time_course", "factors": [{"name": "f", "type": "time", "levels": ["a"]}],
    "replicate_groups": [{"group_id": "g", "label_human": "G", "sample_ids": ["GSM1"], "primary_role": "treated", "factor_levels": [{"key": "k", "value": "v"}]}],
    "comparisons": [{"comparison_id": "c", "treated_group": "g", "control_group": "h", "control_type": "vehicle", "design_kind": "unclear", "varying_factor": "f", "fixed_factors": [], "study_internal_score": 0.5}],
    "extraction": {"schema_version": "stage2.v2", "model": "m", "confidence": 0, "ambiguity_flags": [], "input_sample_count": 1, "input_truncated": False},
}


def breaches(contract, value, *path, to=None, drop=False):
    value = json.loads(json.dumps(value))
    at = value
    for p in path[:-1]:
        at = at[p]
    if drop:
        del at[path[-1]]
    elif path:
        at[path[-1]] = to
    out = []
    compile_contract(contract)(value, "", out)
    return out


def test_contracts_accept_and_name_every_breach():
    assert breaches(FACT_CONTRACT, FACT) == [] and breaches(DESIGN_CONTRACT, DESIGN) == []
    assert breaches(FACT_CONTRACT, FACT, "perturbations", 0, "kind", to="magic") == ["/perturbations/0/kind: not an allowed value"]
    assert breaches(FACT_CONTRACT, FACT, "extraction", drop=True) == [": missing extraction"]
    assert breaches(FACT_CONTRACT, FACT, "cell_context", "more", to=1) == ["/cell_context: additional more"]
    assert breaches(FACT_CONTRACT, FACT, "perturbations", 0, "agent_normalized", "id", to=5) == ["/perturbations/0/agent_normalized/id: must be string"]
    assert breaches(FACT_CONTRACT, FACT, "perturbations", 0, "temporal_order", to=0) == ["/perturbations/0/temporal_order: below 1"]
    assert breaches(FACT_CONTRACT, FACT, "perturbations", 0, "temporal_order", to=True) == ["/perturbations/0/temporal_order: must be integer"]
    assert breaches(FACT_CONTRACT, FACT, "extraction", "raw_input_hash", to="sha256:x")[0].startswith("/extraction/raw_input_hash: must match")
    assert breaches(FACT_CONTRACT, FACT, "extraction", "schema_version", to="v1") == ["/extraction/schema_version: must be stage1.v3"]
    assert breaches(FACT_CONTRACT, FACT, "perturbations", to={"kind": "none"}) == ["/perturbations: must be array"]
    assert breaches(DESIGN_CONTRACT, DESIGN, "design_kind", to="odd") == ["/design_kind: not an allowed value"]
    assert breaches(DESIGN_CONTRACT, DESIGN, "replicate_groups", to=[]) == ["/replicate_groups: fewer than 1 items"]
    assert breaches(DESIGN_CONTRACT, DESIGN, "design_summary", to="short") == ["/design_summary: too short"]
    assert breaches(DESIGN_CONTRACT, DESIGN, "comparisons", 0, "study_internal_score", to=2) == ["/comparisons/0/study_internal_score: above 1"]
    assert breaches(FACT_CONTRACT, 7) == [": must be object"] and breaches(FACT_CONTRACT, None) == [": must be object"]


def test_validation_of_a_table(spark):
    rows = [(1, json.dumps(FACT), "x"), (1, json.dumps(FACT), "x"), (2, "{cut", None), (3, None, None), (4, "", None), (5, "[]", None), (6, "[" * 100_000, None)]
    df = spark.createDataFrame(rows, "id int, t string, errors string")
    got = [(r.id, r.parsed, r.valid, r.errors) for r in validate(df, "id", "t", FACT_CONTRACT).collect()]
    assert got == [(1, True, True, []), (1, True, True, []), (2, False, False, []), (3, False, False, []), (4, False, False, []), (5, True, False, [": must be object"]), (6, False, False, [])]
    assert validate(df.limit(0), "id", "t", FACT_CONTRACT).count() == 0


def test_forced_fields_and_failure_records(spark):
    lie = {**FACT, "geo_accession": "GSM666", "series_id": "GSE666", "extraction": {**FACT["extraction"], "model": "liar", "raw_input_hash": None}}
    bare = {"geo_accession": "GSM9"}
    df = spark.createDataFrame([(1, json.dumps(lie)), (2, json.dumps(bare)), (3, "nonsense"), (4, None)], "id int, t string").select("id", collection.parsed_object(F.col("t"), fact_schema()).alias("f"))
    got = {r.id: r.f for r in df.select("id", collection.forced_fact(F.col("f"), F.lit("GSM1"), F.lit("GSE1"), F.lit("text"), "m").alias("f")).collect()}
    assert (got[1].geo_accession, got[1].series_id, got[1].extraction.model, got[1].extraction.confidence) == ("GSM1", "GSE1", "m", 1.0)
    assert got[1].extraction.raw_input_hash == "sha256:982d9e3eb996f559e633f4d194def3761d909f5a3b647d1a851fead67c32c9d1"
    assert got[2].geo_accession == "GSM9" and got[3] is None and got[4] is None
    skeleton = df.limit(1).select(F.to_json(collection.failure_record(F.lit("GSM1"), F.lit("GSE1"), F.lit(None).cast("string"), "m"), {"ignoreNullFields": "false"})).first()[0]
    assert breaches(FACT_CONTRACT, json.loads(skeleton)) == []
    d = spark.createDataFrame([('{"design_summary": "x"}',), ('{"extraction": {"input_truncated": true}}',)], "t string").select(F.from_json("t", design_schema()).alias("d"))
    e = [r.d.extraction for r in d.select(collection.forced_design(F.col("d"), F.lit("GSE1"), F.lit(7), "m").alias("d")).collect()]
    assert [(x.schema_version, x.input_sample_count, x.input_truncated) for x in e] == [("stage2.v2", 7, False), ("stage2.v2", 7, True)]


def test_states_and_attributes(spark):
    cases = [("running", "completed", "completed"), ("completed", "running", "completed"), ("collected", "completed", "collected"), ("failed", "completed", "completed"), ("created", None, "created"), ("completed", "failed", "failed")]
    df = spark.createDataFrame([c[:2] for c in cases], "a string, b string")
    assert [r[0] for r in df.select(collection.next_state(F.col("a"), F.col("b"))).collect()] == [c[2] for c in cases]
    j = spark.createDataFrame([('{"a":1}',), (" {} ",), ("[1]",), (None,)], "j string")
    assert [r[0] for r in j.select(collection.with_attribute(F.col("j"), "n", F.lit(5))).collect()] == ['{"a":1,"n":5}', '{"n":5}', "[1]", None]


def test_assertions(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert collection.union_exact([a, b], 4).count() == 4
    with pytest.raises(ValueError, match="4 rows, not 5"):
        collection.union_exact([a, b], 5)
    with pytest.raises(ValueError, match="k 2 is in both"):
        collection.require_disjoint(a, b, "k")
    collection.require_disjoint(a, b.filter("k > 2"), "k")
    with pytest.raises(ValueError, match="0 rows to replace"):
        collection.replace_exactly_one(a, "k", b.filter("k = 3"))
    with pytest.raises(ValueError, match="occurs 2 times"):
        sampling.require_unique(a.union(a), "k")
    with pytest.raises(ValueError, match="pool: 2 rows, fewer than 3"):
        sampling.require_rows(a, 3, "pool")
    with pytest.raises(Exception, match="no rows to rate"):
        evaluation.validity_rate(spark.createDataFrame([], "v boolean"), "v").collect()
    labels = spark.createDataFrame([(1, "treated"), (2, None), (3, "odd")], "id int, gold string")
    with pytest.raises(ValueError, match="unknown gold: odd"):
        import_reviewed(labels, ["id"], "gold", ["treated"])
    with pytest.raises(ValueError, match="missing columns: tier"):
        import_reviewed(labels, ["tier"], "gold", ["treated"])


def test_index_of_maps(spark):
    nodes = [(0, "GSE1, GSE2", {"a": ["x", "y"], "b": ["z"]}), (1, "GSE2,,", {"a": ["q"]}), (2, None, {"a": ["q"]}), (3, "GSE3", {}), (4, "GSE4", None)]
    got = collection.index_sizes(spark.createDataFrame(nodes, "node int, ids string, groups map<string,array<string>>"), "ids", "groups").collect()
    assert {r.series: r.n_signatures for r in got} == {"GSE1": 3, "GSE2": 3, "GSE3": 0, "GSE4": 0}


def test_retry_and_two_steps():
    waits, calls = [], []

    def busy(k):
        calls.append(k)
        if len(calls) < 3:
            raise lookup.Transient("busy")
        return k

    assert lookup.retrying(busy, 3, 2.0, waits.append)("a") == "a" and waits == [2.0, 4.0]
    with pytest.raises(lookup.Transient):
        lookup.retrying(lambda k: (_ for _ in ()).throw(lookup.Transient("x")), 2, 1.0, waits.append)("a")
    asked = []

    def search(start, n):
        asked.append((start, n))
        return [(f"GSE{i},GSE{i}1", i) for i in range(start, min(start + n, 1500))]

    assert lookup.two_step_search(search, "GSE7") == 7 and asked == [(0, 50)]
    assert lookup.two_step_search(search, "GSE1200") == 1200 and lookup.two_step_search(search, "none") is None and asked[-1] == (1000, 1000)


def test_bundle_guards(spark, tmp_path):
    root = f"file://{tmp_path}/b"
    df = spark.createDataFrame([(1, "a"), (1, "b")], "id int, t string")
    with pytest.raises(ValueError, match="1 null or repeated ids"):
        bundles.write_bundle(spark, df, "id", root, "r", "s", "p", {}, {})
    with pytest.raises(FileNotFoundError, match="no bundle of run r"):
        bundles.recover(spark, root, "r")
    bundles.write_bundle(spark, df.limit(1), "id", root, "r", "s", "p", {}, {"temperature": 0, "top_p": None})
    with pytest.raises(FileExistsError):
        bundles.write_bundle(spark, df.limit(1), "id", root, "r", "s", "p", {}, {})
    assert json.loads(bundles.read_text(spark, f"{root}/r/generation.json")) == {"temperature": 0.0, "top_p": None}


def test_models_fail_alone(spark):
    def fails(prompts):
        raise ValueError("no")

    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, p string")
    got = backend.many_models(df, "id", "p", {"good": lambda ps: [str(p) for p in ps], "bad": fails}).collect()
    assert sorted((r.id, r.model, r.output, r.error) for r in got if r.model == "good") == [(1, "good", "a", None), (2, "good", "None", None)]
    assert all(r.error == "ValueError: no" for r in got if r.model == "bad")


def test_cap_is_checked_before_the_work(spark, tmp_path):
    df = spark.createDataFrame([(i,) for i in range(30)], "id int")
    df.repartition(3, "id").write.parquet(f"{tmp_path}/in")
    args = (spark, f"{tmp_path}/in", df.schema, f"{tmp_path}/out", f"{tmp_path}/state", lambda b: b, "id")
    with pytest.raises(Exception, match="more than 1 chunks"):
        resume.run_resumable(*args, files_per_trigger=1, cap=1)
    done = spark.read.parquet(f"{tmp_path}/out").count()
    assert 0 < done < 30
    resume.run_resumable(*args, files_per_trigger=1)
    assert spark.read.parquet(f"{tmp_path}/out").select("id").distinct().count() == spark.read.parquet(f"{tmp_path}/out").count() == 30


def test_lock(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "id int")
    df.write.parquet(f"{tmp_path}/in")
    (tmp_path / "state.lock").write_text("")
    with pytest.raises(RuntimeError, match="in use"):
        resume.run_until_done(spark, f"{tmp_path}/in", df.schema, f"{tmp_path}/out", f"{tmp_path}/state", lambda b: b, "id")
    (tmp_path / "state.lock").unlink()
    seen = resume.run_until_done(spark, f"{tmp_path}/in", df.schema, f"{tmp_path}/out", f"{tmp_path}/state", lambda b: b, "id")
    assert seen[-1]["state"] == "completed" and sum(s["rows"] for s in seen) == 1 and not (tmp_path / "state.lock").exists()


def test_wanted_shards(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "1", "v": 1}\n{"id": "2", "v": 1}\n{"id": "3", "v"\nplain\n')
    (tmp_path / "b.jsonl").write_text('{"id": "1", "v": 2}\n{"id": "3", "v": 2}\n')
    got = files.read_shards(spark, f"{tmp_path}/*.jsonl", "id")
    assert {r.key: json.loads(r.value)["v"] for r in got.collect()} == {"1": 1, "2": 1, "3": 2}
    wanted = spark.createDataFrame([("3",)], "key string")
    assert [r.key for r in files.read_shards(spark, f"{tmp_path}/*.jsonl", "id", wanted=wanted).collect()] == ["3"]


def test_store_keeps_valid_values_only(spark, tmp_path):
    wanted = spark.createDataFrame([("a", "xx"), ("a", "xx"), ("b", ""), (None, "x")], "key string, payload string")
    compute = lambda m: m.select("key", F.length("payload").cast("string").alias("value"))
    call = lambda: sorted((r.key, r.value, r.hit) for r in runs.stored_read_through(spark, wanted, f"{tmp_path}/s", compute, F.col("value") != "0").collect())
    assert call() == [("a", "2", False)] and call() == [("a", "2", True)]


def test_shards_of_sparse_ids_and_bounded_groups(spark):
    from cohortloom.operators import batching

    ids = [(i * 10**15 + i % 3,) for i in range(-20, 60)]
    got = {r.id: r.shard for r in batching.round_robin(spark.createDataFrame(ids, "id long"), "id", 7, bucket_rows=9).collect()}
    assert got == {i: k % 7 for k, (i,) in enumerate(sorted(ids))}
    assert batching.round_robin(spark.createDataFrame([], "id long"), "id", 7).count() == 0
    docs = spark.createDataFrame([(1, i, "text") for i in range(5)], "g int, o int, t string")
    with pytest.raises(Exception, match="group 1 has 5 rows, more than 4"):
        batching.greedy_chunks(docs, "g", "o", "t", 100, 10, 1, max_group_rows=4).collect()
