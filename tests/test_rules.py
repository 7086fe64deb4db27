"""Literal cases of text rules, keys, metrics, resolution, batching and state folds."""

import json
import math

import pytest
from pyspark.sql import functions as F

from cohortloom.contracts import fact_schema
from cohortloom.functions import text as X
from cohortloom.operators import backend, batching, evaluation, records, runs, sampling, studies
from cohortloom.operators.contracts_check import Rule, contract_errors, out_of_vocabulary, record_report
from cohortloom.operators.prefix import running_sum
from cohortloom.sources import files
from cohortloom.streaming import resume


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_dose_and_duration_keys(spark):
    assert column(spark, ["10 nM", "1 µM", None, "", "standard"], X.dose_key) == ["10nM", "1uM", "nodose", "nodose", "standard"]
    got = column(spark, ["1 h", "3 hours", "90 min", "2 days", "6d", None, "20 min", "5.5 d", "24", "1.2.3h"], X.duration_key)
    assert got == ["1h", "3h", "1.5h", "48h", "6d", "na", "0.3333333h", "132h", "24", "1.2.3h"]


def test_kinds_and_labels(spark):
    cases = {
        "si-GAPDH knockdown HEK293": "knockdown_panel", "+Dox induced shRNA TP53": "knockdown_panel", "0Gy sham 10Gy irradiation MCF7": "treatment_vs_untreated", "DMSO vehicle trametinib 1uM": "treatment_vs_vehicle",
        "0h 6h 24h time course": "time_course", "glioblastoma patient healthy normal": "disease_vs_normal", "conditioned media transwell coculture bystander": "mediated_effect", "WT mouse TP53 -/- knockout mouse": "knockout_vs_wt",
        "+drug +siRNA factorial": "factorial", "random nondescript": "unknown",
    }
    assert column(spark, [*cases, None], X.design_kind) == [*cases.values(), "unknown"]
    assert column(spark, ["treatment: DMSO", "treatment: drug X 10nM", "treatment: control siRNA", "treatment: shGAPDH", None], X.control_label) == ["control", "treated", "control", "treated", "treated"]


def test_roles(spark):
    assert column(spark, ["treated", "case", "baseline_t0", "bystander", None], X.role_binary) == ["treated", "treated", "control", None, None]
    with pytest.raises(Exception, match="unknown role"):
        column(spark, ["nonsense"], X.role_binary)


def test_composed_text(spark):
    df = spark.createDataFrame([(None, "src", "key: value"), ("", "", "key: value"), (None, None, None)], "t string, s string, c string")
    assert [r[0] for r in df.select(X.composed_text(F.col("t"), F.col("s"), F.col("c"))).collect()] == ["source: src,key: value", "key: value", ""]


def anchor(spark, fact, role="treated"):
    df = spark.createDataFrame([(json.dumps(fact),)], "t string").select(F.from_json("t", fact_schema()).alias("fact"))
    return df.select(X.anchor_key("fact", F.lit(role))).first()[0]


def test_anchor(spark):
    vegf = {
        "geo_accession": "GSM1", "cell_context": {"cell_type_or_line_raw": "HUVEC", "tissue": "vascular_endothelium", "context_kind": "primary_culture", "cell_state": "proliferating", "engineered_modifications": []},
        "disease_state": {"status": "none"}, "perturbations": [{"kind": "cytokine_stimulation", "agent_normalized": {"id": "HGNC:12680"}, "duration": {"value_raw": "1 h"}, "phase": "exposure"}],
    }
    assert anchor(spark, vegf) == "cytokine_stim|HGNC:12680|wt|nodose|1h|exposure|HUVEC|primary_culture|proliferating|whole_cell|vascular_endothelium|none|false"
    assert anchor(spark, vegf, "case").startswith("disease_vs_normal|unknown|wt|") and anchor(spark, vegf, "case").split("|")[11] == "case"
    mediated = vegf | {"perturbations": [{"kind": "small_molecule", "mediated_effect": {"kind": "genetic_overexpression", "targets": ["SOX17"]}}]}
    assert anchor(spark, mediated).startswith("genetic_overexpression|HGNC:SOX17|")
    assert anchor(spark, {"geo_accession": "GSM1"}) == "none|none|wt|nodose|na|exposure|unclear|unclear|proliferating|whole_cell|na|none|false"


def test_small_rules(spark):
    assert column(spark, ["20260507T093012Z-alpha-xlsx-stage1-a3f9c1", "a-b"], X.short_run_id) == ["alpha-xlsx-stage1", "a-b"]
    assert column(spark, ["GSE1#3", "GSE1--rsc2of4", "GSE1"], X.base_id) == ["GSE1"] * 3
    assert column(spark, [" Héllo, World! ", "", None, "---"], X.slug) == ["h-llo-world", None, None, None]
    assert column(spark, ["```json\n{}\n```", "{}"], X.without_fence) == ["{}", "{}"]
    assert column(spark, ['{"a":1}', 'x {"a":1} y', "nope", None], X.tolerant_json) == ['{"a":1}', '{"a":1}', None, None]
    assert column(spark, ["x" + "\t" * 30, "y" * 2500, "z", None], X.failure_mode) == ["A", "B", "other", "other"]
    assert column(spark, ["1-02:03:04", "00:10:00", "bad"], X.clock_seconds) == [93784, 600, None]
    assert column(spark, ["abcd", "abcde", "", None], X.token_estimate) == [1, 2, 1, 1]
    kib = 1024
    assert column(spark, [5 * kib, 14 * kib - 1, 15 * kib, 20 * kib, 25 * kib, 34 * kib, 35 * kib, 100 * kib], X.size_tier, "int") == ["S", "S", "M", "M", "L", "L", "XL", "XL"]
    assert column(spark, ["Study [RNA-Seq] x", "(bulk) x", "plain"], lambda c: c.rlike(X.METHOD_TAG)) == [True, True, False]
    with pytest.raises(Exception, match="open placeholder"):
        column(spark, ["x __A__ __B__"], lambda c: X.render(c, {"A": F.lit("1")}))


def test_wilson_and_metrics(spark):
    df = spark.range(1).select(*[c.alias(n) for c, n in zip(evaluation.wilson(F.lit(50), F.lit(100)), ("low", "high"))]).first()
    assert round(df.low, 4) == 0.4038 and round(df.high, 4) == 0.5962
    assert spark.range(1).select(evaluation.wilson(F.lit(0), F.lit(0))[0]).first()[0] is None
    rows = spark.createDataFrame([("treated", "treated"), ("control", "treated"), ("control", "control"), (None, "treated"), ("treated", None)], "gold string, pred string")
    m = evaluation.binary_metrics(rows, "gold", "pred").first()
    assert m.n == 3 and round(m.accuracy, 4) == 0.6667 and m.specificity == 0.5
    empty = evaluation.binary_metrics(rows.limit(0), "gold", "pred").first()
    assert empty.n == 0 and empty.accuracy is None


def test_paired_tests(spark):
    rows = [(True, False)] * 20 + [(False, True)] * 10 + [(True, True)] * 50 + [(None, True)]
    df = spark.createDataFrame(rows, "a boolean, b boolean")
    m = evaluation.mcnemar(df, "a", "b").first()
    assert (m.b, m.c) == (20, 10) and round(m.chi_square, 3) == 3.333 and round(m.p_value, 4) == round(math.erfc(math.sqrt(10 / 6)), 4)
    none = evaluation.mcnemar(df.filter("a and b"), "a", "b").first()
    assert none.chi_square is None and none.p_value is None
    ci = evaluation.bootstrap_delta(df, "a", "b").first()
    assert ci.low < ci.delta < ci.high and round(ci.delta, 4) == round(10 / 80, 4) and ci == evaluation.bootstrap_delta(df, "a", "b").first()
    assert evaluation.bootstrap_delta(df.limit(0), "a", "b").count() == 0


def test_holm_majority_tiers(spark):
    df = spark.createDataFrame([(i, p) for i, p in enumerate([0.04, 0.01, None, 0.03, 0.02])], "i int, p double")
    assert [r.p_holm for r in evaluation.holm(df, "p", order=["i"]).orderBy("i").collect()] == pytest.approx([0.06, 0.04, None, 0.06, 0.06])
    votes = spark.createDataFrame([(1, "b"), (1, "a"), (2, "x"), (2, "y"), (2, "y"), (3, None)], "g int, v string")
    assert sorted(map(tuple, evaluation.majority(votes, ["g"], "v").collect())) == [(1, "a", 1), (2, "y", 2)]
    assert column(spark, [0.60, 0.59, 0.45, 0.44, None], evaluation.difficulty_tier, "double") == ["easy", "medium", "medium", "hard", None]
    assert spark.range(1).select(evaluation.confidence_score(F.lit(1.0), F.lit(0.5), F.lit(0.0))).first()[0] == pytest.approx(0.55)


def test_series_resolution(spark):
    known = spark.createDataFrame([("GSE1", False, True), ("GSE2", False, False), ("GSE3", True, False), ("GSE4", False, True), ("GSE5", True, True)], "series_id string, is_super boolean, has_srp boolean")
    cases = {
        "GSE1": ("GSE1", "single_gse"), "GSE3,GSE2": ("GSE2", "clean_super_scarted"), "GSE3,GSE5": ("GSE3", "all_super_pathological"), "GSE1,GSE2": ("GSE1", "srp_a_only"), "GSE2, GSE1": ("GSE1", "srp_b_only"),
        "GSE4,GSE1": ("GSE1", "tiebreak_both_srp"), "GSE10,GSE9": ("GSE9", "fallback_no_srp"), "GSE2,GSE9,GSE4": ("GSE4", "srp_one_of_many"), "GSE2,GSE9,GSE10": ("GSE2", "multi_gse_multi_branch"), None: (None, "no_series"),
    }
    s = spark.createDataFrame([(k,) for k in cases] + [("GSE1",)], "series string")
    got = studies.resolve_series(s, "series", known).collect()
    assert len(got) == len(cases) + 1 and all((r.resolved, r.branch) == cases[r.series] for r in got)


def test_groups_and_comparisons(spark):
    g = spark.createDataFrame([("s", "2", ["d", "a"]), ("s", "10", ["c"]), ("t", "1", ["x"])], "series_id string, group_key string, sample_ids array<string>")
    assert {(r.series_id, r.sample): r.label for r in studies.ordinal_labels(g).collect()} == {("s", "d"): "treated", ("s", "a"): "treated", ("s", "c"): "control", ("t", "x"): "control"}
    d = spark.createDataFrame(
        [("s", [("g1", "treated", ["a", "b"]), ("g2", "control", ["c"]), ("g2", "control", ["c", "d"]), ("g3", "treated", [])], [("c1", "g1", "g2"), ("c2", "g1", "none"), ("c3", "g3", "g2"), ("c4", "lost", "g2")])],
        "series_id string, groups array<struct<group_id:string,role:string,sample_ids:array<string>>>, pairs array<struct<comparison_id:string,treated:string,control:string>>",
    )
    facts = spark.createDataFrame([("a", "k")], "sample string, anchor string")
    got = {r.comparison_id: (r.n_samples_treated, r.n_samples_control) for r in studies.comparisons(d, facts).collect()}
    assert got == {"c1": (2, 2), "c2": (2, 0)}
    assert {r.sample: r.role for r in studies.sample_roles(d).collect()} == {"a": "treated", "b": "treated", "c": "control", "d": "control"}


def test_records(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 5, "d")], "k int, o int, v string")
    assert sorted(r.v for r in records.pick(df, ["k"], [F.col("o")]).collect()) == ["a", "c", "d"]
    assert sorted(r.v for r in records.pick(df, ["k"], [F.col("o")], last=True).collect()) == ["b", "c", "d"]
    patched = records.overlay(df, spark.createDataFrame([(2, "new")], "k int, v string"), "k", ["v"], "fix")
    assert sorted((r.v, r.source) for r in patched.collect()) == [("a", "base"), ("b", "base"), ("d", "base"), ("new", "fix")]
    genes = [spark.createDataFrame([("VEGFA", "HGNC:12680")], "name string, entry string"), spark.createDataFrame([("VEGF", "HGNC:12680")], "name string, entry string"), spark.createDataFrame([("VEGF", "old")], "name string, entry string")]
    needles = spark.createDataFrame([("VEGF",), ("vegfa",), ("none",), (None,)], "n string")
    assert {r.n: (r.entry, r.resolved_via) for r in records.first_hit(needles, "n", genes).collect()} == {"VEGF": ("HGNC:12680", 1), "vegfa": ("HGNC:12680", 0), "none": (None, None)}
    merged = records.priority_union([("main", 0, df.filter("k = 1").select("k", "v").limit(1)), ("rescue", 1, df.filter("k = 2"))], "k")
    assert {r.k: r.source for r in merged.collect()} == {1: "main", 2: "rescue"}


def test_running_sum_over_one_hot_group(spark):
    df = spark.range(5000).select("id", F.lit("hot").alias("g"), (F.col("id") % 7).alias("v"))
    got = running_sum(df, "g", F.floor(F.col("id") / 100), ["id"], F.col("v"), "before").orderBy("id").collect()
    total = 0
    for r in got:
        assert r.before == total
        total += r.v
    nulls = spark.createDataFrame([(None, 1, 2), (None, 2, None), ("a", 1, 3)], "g string, i int, v int")
    assert sorted((r.g or "", r.i, r.before) for r in running_sum(nulls, "g", F.lit(0), ["i"], F.col("v"), "before").collect()) == [("", 1, 0), ("", 2, 2), ("a", 1, 0)]


def test_greedy_chunks_properties(spark):
    import random

    rnd = random.Random(2)
    sizes = [rnd.choice([4, 40, 400, 900, 6000]) for _ in range(400)]
    df = spark.createDataFrame([("g", i, "x" * n) for i, n in enumerate(sizes)], "g string, o int, t string")
    plan = batching.greedy_chunks(df, "g", "o", "t", 1000, 50, 10, 0.5, 6).orderBy("chunk_id").collect()
    cost = [max(1, math.ceil(n / 4)) + 10 for n in sizes]
    at = 1
    for k, c in enumerate(plan):
        assert c.start_index == at and c.end_index == at + c.record_count - 1
        spent = 50 + sum(cost[c.start_index - 1 : c.end_index])
        assert spent == c.estimated_tokens and (c.oversize or (spent <= 500 and c.record_count <= 6)) and (not c.oversize or c.record_count == 1)
        if not c.oversize and k + 1 < len(plan):
            assert spent + cost[c.end_index] > 500 or c.record_count == 6
        at = c.end_index + 1
    assert at == len(sizes) + 1
    assert batching.greedy_chunks(df.limit(0), "g", "o", "t", 1000, 50, 10).count() == 0


def test_nested_chunks_and_rechunk(spark):
    df = spark.createDataFrame([("g", i) for i in range(120)] + [("h", 1)], "g string, i int")
    c = batching.nested_chunks(df, "g", "i", ["i"], 50)
    assert sorted((r.record_id, r.n_samples) for r in c.collect()) == [("g#1", 50), ("g#2", 50), ("g#3", 20), ("h", 1)]
    parts = batching.rechunk(c, "record_id", "samples", 25).collect()
    assert sorted(x.i for r in parts for x in r.samples if r.g == "g") == list(range(120)) and {r.record_id for r in parts} >= {"g#1--rsc1of2", "g#3--rsc1of1", "h--rsc1of1"}


def test_deficit_sampling(spark):
    have = {"a": 20, "m": 5, "v": 50, "u": 20}
    df = spark.createDataFrame([(f"{k}{i}", k) for k, n in have.items() for i in range(n)], "id string, kind string")
    got = sampling.stratified(df, "kind", {"a": 15, "m": 10, "v": 20}, "id", 1, fallback="v").groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in got} == {"a": 15, "m": 5, "v": 25}
    assert sorted(map(tuple, sampling.top_by_hash(df, 7, "id", 3).collect())) == sorted(map(tuple, sampling.top_by_hash(df.repartition(7), 7, "id", 3).collect()))


def test_run_states_against_the_fold(spark):
    import random

    rnd = random.Random(1)
    names = ["queued", "running", "completed", "failed", "collected", "submitted"]
    rows, want = [], {}
    for run in range(200):
        state = None
        for i in range(rnd.randint(1, 8)):
            s = rnd.choice(names)
            rows.append((run, i, s))
            if state is None:
                state = s
            elif state == "collected" and s == "completed" or state in runs.TERMINAL and s not in runs.TERMINAL:
                pass
            else:
                state = s
        want[run] = state
    got = runs.stable_state(spark.createDataFrame(rows, "run int, o int, state string"), "run", ["o"], "state")
    assert {r.run: r.state for r in got.collect()} == want
    assert column(spark, ["COMPLETED", "CANCELLED by 5", "NODE_FAIL+", "", None, "odd", " Pending "], runs.scheduler_state) == ["completed", "cancelled", "failed", None, None, "submitted", "queued"]


def test_cache_and_registry(spark, tmp_path):
    log = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "3", 1)], "key string, value string, put_at int")
    for _ in range(2):
        runs.cache_put(log, str(tmp_path), "ns")
    assert spark.read.parquet(str(tmp_path / "ns")).count() == 6
    assert {r.key: r.value for r in runs.cache_get(spark, str(tmp_path), "ns", log).collect()} == {"a": "2", "b": "3"}
    with pytest.raises(ValueError):
        runs.cache_path("x", "bad name")
    asked = spark.createDataFrame([("a", "x"), ("c", "y"), ("c", "y")], "key string, payload string")
    got = runs.read_through(asked, log, lambda m: m.select("key", F.upper("payload").alias("value"))).collect()
    assert sorted((r.key, r.value, r.hit) for r in got) == [("a", "2", True), ("c", "Y", False)]
    updates = spark.createDataFrame([("r", 1, "x", None), ("r", 2, None, "y")], "run string, at int, p string, q string")
    assert tuple(runs.run_upsert(updates, "run", "at").first()) == ("r", "x", "y", 2)
    slow = spark.range(1).select(runs.job_seconds(F.lit(60), F.lit(60), F.lit(30000), large=True).alias("e"))
    assert slow.select(runs.time_status(F.lit(300), F.col("e"))).first()[0] == "too_low"


def test_contracts_and_backend(spark):
    rules = [Rule("k", ("string",), enum=("a", "b")), Rule("n", ("number", "null"), minimum=0, maximum=1), Rule("o", ("string",), required=False, pattern="^x")]
    values = ['{"k":"a","n":0.5}', '{"k":"c","n":2}', '{"n":null}', '{"k":1,"n":"x","z":0}', '{"k":"a","n":0,"o":"y"}', "broken", None, "[]"]
    got = column(spark, values, lambda c: F.array_join(contract_errors(c, rules), "; "))
    assert got == ["", "enum: k; maximum: n", "missing: k", "additional: z; type: k; enum: k; type: n", "pattern: o", "not an object", "not an object", "not an object"]
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, p string")
    out = backend.run_backend(df, "id", "p", lambda ps: [p.upper() for p in ps]).orderBy("id").collect()
    assert [(r.output, bool(r.error)) for r in out] == [("A", False), (None, True), ("B", False)]
    assert tuple(record_report(spark.createDataFrame([("a",), ("a",), (" ",), (None,)], "id string"), "id").first()) == (4, 2, 1)
    assert out_of_vocabulary(spark.createDataFrame([("a",), ("q",), (None,)], "v string"), "v", ["a"]).collect()[0][0] == "q"


def test_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a":1}\n\nbroken\n{"a":2}\n')
    schema = spark.createDataFrame([], "a int").schema
    assert files.read_jsonl(spark, str(tmp_path / "a.jsonl"), schema).count() == 2
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "a.jsonl"), schema, strict=True).collect()
    for name, rows in (("w.1.jsonl", ['{"id":"x","v":1}', '{"id":"y","v":1}']), ("w.2.jsonl", ['{"id":"x","v":2}'])):
        (tmp_path / name).write_text("\n".join(rows))
    got = {r.key: r.value for r in files.read_shards(spark, str(tmp_path / "w.*.jsonl"), "id").collect()}
    assert '"v":1' in got["x"] and set(got) == {"x", "y"}
    with pytest.raises(ValueError, match="missing columns: b"):
        files.require(spark.createDataFrame([], "a int"), ["a", "b"])
    assert files.provenance(spark, str(tmp_path / "a.jsonl"), "x").first().n_bytes == 24
    assert files.paged(spark, lambda p, n: [(p, n)], 3, "page int, size int").count() == 3
    files.write_template(spark.createDataFrame([("b", None), ("a", "x")], "k string, v string"), str(tmp_path / "t"), ["k"])
    assert spark.read.option("header", True).csv(str(tmp_path / "t")).count() == 2


def test_stream_resumes(spark, tmp_path):
    source, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = spark.createDataFrame([], "id int").schema
    for k in range(3):
        spark.createDataFrame([(i,) for i in range(k * 5, k * 5 + 8)], schema).coalesce(1).write.mode("append").parquet(source)
        resume.run_resumable(spark, source, schema, target, state, lambda b: b.withColumn("x", F.col("id") * 2), "id")
    out = spark.read.parquet(target)
    assert out.count() == 18 and out.select("id").distinct().count() == 18
    assert resume.run_resumable(spark, source, schema, target, state, lambda b: b, "id") == 0
    assert resume.pending(spark.range(5).withColumnRenamed("id", "i"), spark.range(3).withColumnRenamed("id", "i"), "i").count() == 2
