"""Queries of run handling: contracts, enrichment, collection, status, bundles, lookups, inference backends, checked unions."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import FACT_CONTRACT, design_schema
from ..functions import text as X
from ..operators import backend, batching, collection, records, runs
from ..operators.nested_contract import validate
from ..sources import bundles, files, lookup
from ..streaming import resume
from ..workspace import materialize, shared_dir
from .batch_queries import _SAMPLES, _samples


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _root(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/cohortloom/{name}-{uuid.uuid4().hex}"


def _facts(spark, sf):
    return _t(spark, sf, "fact_records").select("fact_id", "record_id", "series_id", "raw_output", "valid_schema", "worker_id", "ts")


def contract_breaches(spark, sf):
    """Top-level breaches of the nested contract in facts that are read strictly: missing and unknown fields."""
    v = validate(_facts(spark, sf), "fact_id", "raw_output", FACT_CONTRACT).filter("parsed")
    top = F.filter("errors", lambda e: e.startswith(": missing ") | e.startswith(": additional "))
    return v.select("fact_id", F.array_join(F.transform(top, lambda e: F.substring(e, 3, 100)), "; ").alias("top_level"))


def contract_ids(spark, sf):
    """Facts with perturbations whose agent's id isn't text, by the nested validator."""
    v = validate(_facts(spark, sf), "fact_id", "raw_output", FACT_CONTRACT).filter("parsed")
    n = F.size(F.filter("errors", lambda e: e.rlike(r"^/perturbations/\d+/agent_normalized/id: must be string$")))
    return v.select("fact_id", n.alias("n_ids")).filter("n_ids > 0")


def strict_rates(spark, sf):
    """Share of outputs that parse and share whose recorded validity says yes, per worker."""
    v = validate(_facts(spark, sf), "fact_id", "raw_output", FACT_CONTRACT)
    f = _facts(spark, sf).join(v, "fact_id")
    return f.groupBy("worker_id").agg(F.count("*").alias("n"), F.round(F.avg(F.col("parsed").cast("double")), 6).alias("parse_rate"), F.round(F.avg(F.coalesce("valid_schema", F.lit(False)).cast("double")), 6).alias("recorded_rate"))


def contract_report(spark, sf):
    """Breaches of the nested contract by place, positions left out; no SQL, see the tests."""
    v = validate(_facts(spark, sf), "fact_id", "raw_output", FACT_CONTRACT)
    return v.select(F.explode("errors").alias("e")).groupBy(F.regexp_replace("e", "/[0-9]+", "/*").alias("breach")).agg(F.count("*").alias("n"))


def _inputs(spark, sf):
    return _samples(spark, sf).select(F.col("geo_accession").alias("record_id"), F.col("geo_accession").alias("accession"), F.col("series_id").alias("series"), F.col("sample_string").alias("text"))


def enriched_facts(spark, sf):
    """Parsed facts with forced ids, version, model and input hash."""
    ok, bad, _ = collection.collect_predictions(_facts(spark, sf).drop("series_id"), _inputs(spark, sf), "raw_output", "valid_schema", "mock:one")
    f = ok.unionByName(bad).filter("fact.extraction is not null")
    return f.select("fact_id", "fact.geo_accession", "fact.series_id", "fact.extraction.schema_version", "fact.extraction.model", "fact.extraction.raw_input_hash", "fact.extraction.confidence")


def collected_summary(spark, sf):
    """Counts of a collected run."""
    ok, bad, summary = collection.collect_predictions(_facts(spark, sf).drop("series_id"), _inputs(spark, sf), "raw_output", "valid_schema", "mock:one")
    collection.require_disjoint(ok, bad, "fact_id")
    return summary


def failure_records(spark, sf):
    """Records that stand for failed outputs."""
    f = _facts(spark, sf).filter("not coalesce(valid_schema, false)").join(_inputs(spark, sf), "record_id", "left")
    r = f.select("fact_id", collection.failure_record(F.col("record_id"), F.col("series"), F.col("text"), "mock:one").alias("r"))
    return r.select("fact_id", "r.geo_accession", "r.series_id", "r.cell_context.context_kind", "r.extraction.confidence", F.array_join("r.extraction.ambiguity_flags", ",").alias("flags"), "r.extraction.raw_input_hash", F.size("r.perturbations").alias("n_perturbations"))


def _chunks(spark, sf):
    return batching.nested_chunks(_samples(spark, sf).filter(F.col("series_id").isNotNull()), "series_id", "geo_accession", ["geo_accession"], 50)


def enriched_designs(spark, sf):
    """Designs answered without extraction, or under a chunk's id, with forced study id and counts."""
    raw = F.when(F.col("n_samples") % 2 == 0, F.to_json(F.struct(F.col("record_id").alias("series_id"), F.lit("a design").alias("design_summary")))).otherwise(
        F.to_json(F.struct(F.lit("a design").alias("design_summary"), F.struct(F.lit(True).alias("input_truncated"), F.lit(0.5).alias("confidence")).alias("extraction")))
    )
    d = _chunks(spark, sf).select("record_id", "series_id", "n_samples", collection.parsed_object(raw, design_schema()).alias("d"))
    e = d.select("record_id", collection.forced_design(F.col("d"), F.col("series_id"), F.col("n_samples"), "mock:two").alias("d"))
    return e.select("record_id", "d.series_id", "d.design_summary", "d.extraction.schema_version", "d.extraction.model", "d.extraction.input_sample_count", "d.extraction.input_truncated", "d.extraction.confidence")


def merged_status(spark, sf):
    """Status of every user's run out of what is stored (first event), the scheduler (last of three kinds) and the run itself (last of two)."""
    states = F.create_map(*[F.lit(x) for kv in {"signup": "queued", "view": "running", "click": "running", "purchase": "completed", "error": "failed"}.items() for x in kv])
    e = _t(spark, sf, "events").select("user_id", "event_id", "event_type", F.struct("ts", "event_id").alias("o"), "ts", states[F.col("event_type")].alias("state"))
    stored = e.groupBy("user_id").agg(F.min_by("state", "o").alias("state"), F.lit("stored").alias("source"), F.min(F.when(F.col("state") == "running", F.col("ts"))).alias("running_at"), F.lit(None).cast("timestamp_ntz").alias("completed_at"), F.lit(None).cast("timestamp_ntz").alias("failed_at"), F.count("*").alias("n_total"), F.lit(None).cast("long").alias("n_done"), F.lit(None).cast("long").alias("n_failed"))
    scheduler = e.filter(F.col("event_type").isin("signup", "view", "click")).groupBy("user_id").agg(F.max_by("state", "o").alias("state"))
    remote = e.filter(F.col("event_type").isin("purchase", "error")).groupBy("user_id").agg(F.max_by("state", "o").alias("state"), F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"), F.lit(None).cast("long").alias("n_total"), F.count_if(F.col("event_type") == "purchase").alias("n_done"), F.count_if(F.col("event_type") == "error").alias("n_failed"))
    # an odd user's run reports nothing itself
    remote = remote.filter(F.col("user_id") % 2 == 0)
    out = collection.merged_status(stored, remote, scheduler, "user_id", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return out.select("user_id", "previous", "state", "source", "changed", stamp("running_at"), stamp("completed_at"), stamp("failed_at"), "n_total", "n_done", "n_failed")


def bundle_parts(spark, sf):
    """A bundle written, recovered from its manifest, and listed from registry and events."""
    root = _root(spark, "bundles")
    d = _t(spark, sf, "documents").select("doc_id", "text")
    bundles.write_bundle(spark, d, "doc_id", root, "run-1", "stage1", "Read the text.", {"type": "object"}, {"temperature": 0, "max_tokens": 4096})
    handle = bundles.recover(spark, root, "run-1")
    registry = bundles.listing(bundles.read_log(spark, f"{root}/_registry", {"run_id": "string", "stage": "string", "state": "string", "n_records": "long", "submitted_at": "string"}), "submitted_at").first()
    events = bundles.read_log(spark, f"{root}/_events", {"run_id": "string", "event": "string", "at": "string"})
    rows = [
        ("generation", bundles.read_text(spark, f"{root}/run-1/generation.json")), ("handle", f"{handle['run_id']} {handle['stage']} {handle['n_records']} {handle['job_id']}"),
        ("prompt", bundles.read_text(spark, f"{root}/run-1/prompt.txt")), ("registry", f"{registry.run_id} {registry.state} {registry.n_records} {registry.submitted_at}"),
    ]
    bundles.replace_text(spark, f"{root}/run-1/status.json", json.dumps({"state": "running"}))
    bundles.replace_text(spark, f"{root}/run-1/status.json", json.dumps({"state": "completed"}))
    rows += [("status", bundles.read_text(spark, f"{root}/run-1/status.json")), ("events", " ".join(r.event for r in events.collect()))]
    p = bundles.provenance(spark, f"{root}/run-1/prompt.txt", "prompt", "https://a.example/prompt").first()
    rows += [("provenance", f"{p.n_bytes} {p.md5} {p.url} {p.label}")]
    back = spark.read.json(f"{root}/run-1/input").agg(F.count("*"), F.sum("doc_id")).first()
    return spark.createDataFrame([*rows, ("input", f"{back[0]} {back[1]}")], "part string, content string")


def registry_log(spark, sf):
    """An event log appended twice, the second time with one more column, read under the newer columns."""
    root = _root(spark, "log")
    e = _t(spark, sf, "events").select("event_id", "user_id", "event_type")
    half = F.col("event_type").isin("view", "click")
    e.filter(half).select("event_id", "user_id").write.mode("append").parquet(root)
    e.filter(~half).write.mode("append").parquet(root)
    log = bundles.read_log(spark, root, {"event_id": "long", "user_id": "long", "event_type": "string"})
    return log.groupBy(F.coalesce("event_type", F.lit("(before)")).alias("event_type")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("n_users"))


def newest_runs(spark, sf):
    """The 25 newest failed or running fact runs per study, those without a time last."""
    f = _facts(spark, sf).groupBy("series_id").agg(F.max(F.when(F.col("valid_schema"), F.col("ts"))).alias("at"), F.bool_and(F.coalesce("valid_schema", F.lit(False))).alias("ok"))
    runs = f.select(F.coalesce("series_id", F.lit("(none)")).alias("run_id"), "at", F.when(F.col("ok"), "completed").when(F.col("at").isNull(), "failed").otherwise("running").alias("state"))
    out = bundles.listing(runs, "at", ["failed", "running"], 25)
    return out.select("run_id", "state", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"))


def cached_lookups(spark, sf):
    """Every study looked up twice: the second time all that was answered comes from the cache; each third key needs a second try, and each seventh fails."""
    root = _root(spark, "lookups")
    tried: dict[str, int] = {}

    def fetch(key):
        n = int(key[3:])
        if n % 7 == 0:
            raise ValueError("no such study")
        tried[key] = tried.get(key, 0) + 1
        if n % 3 == 0 and tried[key] == 1:
            raise lookup.Transient("busy")
        return f"summary of {key}" if n % 2 else None

    keys = _t(spark, sf, "studies").select("series_id")
    first = lookup.cached_lookup(spark, keys, "series_id", fetch, root, base_delay=0.0)
    second = lookup.cached_lookup(spark, keys, "series_id", fetch, root, base_delay=0.0)
    return first.withColumn("round", F.lit(1)).unionByName(second.withColumn("round", F.lit(2)))


def super_flags(spark, sf):
    """Whether a study's own summary says that it is a parent, and the start of the summary."""
    return _t(spark, sf, "studies").select("series_id", X.super_series(F.col("study_summary")).alias("is_super"), F.substring("study_summary", 1, 300).alias("head"))


def paged_rows(spark, sf):
    """A paged source of as many nodes as there are studies, read up to its first short page."""
    n = _t(spark, sf, "studies").count()
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("name", T.StringType())])
    size = max(1, n // 4)

    def fetch(page, size):
        return [(i, f"node {i}") for i in range(page * size, min(n, (page + 1) * size))]

    return lookup.paged_until_short(spark, fetch, schema, page_size=size)


def label_groups(spark, sf):
    """Two-step searches over the studies in order of their number: a short first answer, then long pages."""

    def search(start, n):
        return [(f"GSE{70000000 + 2 * i}, GSE{70000000 + 2 * i + 1}", i) for i in range(start, min(start + n, 2500))]

    @F.udf("long")
    def find(key):
        return lookup.two_step_search(search, key)

    ids = _t(spark, sf, "studies").select("series_id").distinct()
    return ids.select("series_id", find("series_id").alias("node"))


def index_signatures(spark, sf):
    """Sizes of an index whose nodes are lists of studies with a map of label groups."""
    s = _t(spark, sf, "samples").filter(F.col("series_id").isNotNull()).select("series_id", F.coalesce("trtctr_ep", F.lit("")).alias("label"), "geo_accession")
    g = s.groupBy("series_id", "label").agg(F.collect_list("geo_accession").alias("ids")).groupBy("series_id").agg(F.map_from_entries(F.collect_list(F.struct("label", "ids"))).alias("groups"))
    return collection.index_sizes(g.withColumn("node", F.col("series_id")), "series_id", "groups")


def missing_by_study(spark, sf):
    """Studies with samples that no valid output answers."""
    wanted = _samples(spark, sf).select(F.col("geo_accession").alias("record_id"), F.trim(F.split("series_id", ",")[0]).alias("series"))
    done = _facts(spark, sf).join(wanted, "record_id").select("record_id", "series", "valid_schema")
    return collection.missing_predictions(wanted, done, "series", "record_id", F.col("valid_schema"))


def checked_union(spark, sf):
    """Three parts of the samples put together with the row count asserted."""
    s = _t(spark, sf, "samples").select("geo_accession", "series_id")
    n = s.count()
    part = F.length("geo_accession") + F.coalesce(F.length("series_id"), F.lit(0))
    out = collection.union_exact([s.filter(part % 3 == k).withColumn("part", F.lit(k)) for k in range(3)], n)
    return out.groupBy("part").agg(F.count("*").alias("n"))


def moved_parts(spark, sf):
    """Rows of records all of whose outputs are valid move to the predictions, tagged; the rest stay errors."""
    moved, kept = collection.settled_groups(_facts(spark, sf).select("fact_id", "record_id", "valid_schema"), "record_id", F.col("valid_schema"))
    return moved.select("fact_id", "record_id", F.lit("resplit").alias("tag")).unionByName(kept.select("fact_id", "record_id", F.lit("error").alias("tag")))


def curated_row(spark, sf):
    """One study's row replaced by a curated one."""
    s = _t(spark, sf, "studies").select("series_id", "srp")
    key = s.agg(F.min("series_id")).first()[0]
    row = spark.createDataFrame([(key, "CURATED")], "series_id string, srp string")
    return collection.replace_exactly_one(s, "series_id", row).groupBy(F.coalesce("srp", F.lit("(null)")).alias("srp")).agg(F.count("*").alias("n"))


def sibling_results(spark, sf):
    """Failed facts with the smallest valid fact whose input text is the same."""
    f = _facts(spark, sf).join(_inputs(spark, sf), "record_id").select("fact_id", "text", "valid_schema")
    return records.siblings(f.filter("not valid_schema"), f.filter("valid_schema"), "text", "fact_id").select("fact_id", "copied_from")


def long_outputs(spark, sf):
    """Outputs of more than 3500 characters, set aside."""
    return _facts(spark, sf).filter(F.length("raw_output") > 3500).select("fact_id", F.length("raw_output").alias("n"))


def granular_roles(spark, sf):
    """Perturbations in one of the four granular roles, with the role copied, and the coarse role of all."""
    p = _t(spark, sf, "perturbations")
    role = F.when(F.col("is_negative_control"), "negative_inducer_control").when(F.col("phase") == "washout", "baseline_t0").when(F.col("phase") == "recovery", "secondary_arm").when(F.col("temporal_order") == 1, "bystander").otherwise("treated")
    r = p.select("perturbation_id", role.alias("design_role"))
    return r.filter(F.col("design_role").isin(*X.GRANULAR_ROLES)).select("perturbation_id", F.col("design_role").alias("granularity_kind"), X.role_five(F.col("design_role")).alias("role"))


def record_limits(spark, sf):
    """Each study chunk's record with its own token limit in its JSON."""
    c = _chunks(spark, sf).select("record_id", F.to_json(F.struct("record_id", F.col("samples.geo_accession").alias("ids"))).alias("j"))
    limit = X.tier_tokens(X.size_tier(F.octet_length("j") * 20))
    return c.select("record_id", F.md5(collection.with_attribute(F.col("j"), "max_tokens", limit)).alias("record_md5"))


def run_limits(spark, sf):
    """The token limit and model length that the largest chunk needs."""
    c = _chunks(spark, sf).select(F.octet_length(F.to_json(F.struct("record_id", F.col("samples.geo_accession").alias("ids")))).alias("b"))
    tier = X.size_tier(F.col("b") * 20)
    return collection.promoted_limits(c.select(tier.alias("tier"), X.tier_tokens(tier).alias("tokens")), "tier", "tokens", 4096, 32768)


_PRICES = {"mock-small": 0.2, "mock-mid": 1.0, "mock-large": 5.0}


def model_costs(spark, sf):
    """Calls and cost of each model at a price list, carried on to a million calls; models without a price have null."""
    c = _t(spark, sf, "resolver_calls").groupBy("model_name").agg(F.count("*").alias("n"), F.sum(F.coalesce("input_tokens", F.lit(0)) + 4 * F.coalesce("output_tokens", F.lit(0))).alias("units"))
    prices = spark.createDataFrame(list(_PRICES.items()), "model_name string, price double")
    x = c.join(F.broadcast(prices), "model_name", "left")
    cost = F.col("units") * F.col("price") / 1_000_000
    return x.select("model_name", "n", F.round(cost, 6).alias("cost"), F.round(cost / F.col("n") * 1_000_000, 2).alias("cost_of_a_million"))


_SCHEMA = {"type": "object", "required": ["role"], "properties": {"role": {"type": "string"}}}


def schema_prompts(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.md5(X.schema_prompt(" Name the role. ", _SCHEMA, F.col("doc_id"), F.col("text"))).alias("prompt_md5"))


def study_prompts(spark, sf):
    st = _t(spark, sf, "studies").select("series_id", "study_summary")
    c = _chunks(spark, sf).join(st, "series_id", "left")
    several = F.col("chunk_metadata.total_parts") > 1
    p = X.study_prompt(F.col("series_id"), F.col("study_summary"), F.col("samples"), F.when(several, F.col("chunk_metadata.part")), F.when(several, F.col("chunk_metadata.total_parts")), F.when(several, F.col("chunk_metadata.study_total_samples")))
    return c.select("record_id", F.md5(p).alias("prompt_md5"))


def split_messages(spark, sf):
    c = _t(spark, sf, "resolver_calls")
    m = F.array(F.struct(F.lit("system").alias("role"), F.lit("Be brief.").alias("content")), F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content")), F.struct(F.lit("system").alias("role"), F.col("model_name").alias("content")))
    system, rest = X.split_system(m)
    return c.select("call_id", system.alias("system"), F.size(rest).alias("n_rest"))


def label_summaries(spark, sf):
    """The models' labels of each case in one line, and the cases of a pair one line each, in order."""
    c = _t(spark, sf, "resolver_cases").select("case_id", "pair_key", F.concat_ws("; ", F.concat(F.lit("claude="), F.coalesce("claude_choice", F.lit("-"))), F.concat(F.lit("gpt="), F.coalesce("gpt_choice", F.lit("-")))).alias("line"))
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("case_id", "line"))), lambda x: F.concat(x["case_id"].cast("string"), F.lit(" "), x["line"])), "\n")
    return c.groupBy("pair_key").agg(F.count("*").alias("n"), F.md5(lines).alias("overview_md5"))


def provider_round_trip(spark, sf):
    """Requests of two providers' forms, and the fields read off replies of these forms."""
    c = _t(spark, sf, "resolver_calls").select("call_id", "prompt", "reasoning", "model_name", "output_tokens")
    parts = []
    for name in backend.PROVIDERS:
        text = F.coalesce("reasoning", F.lit(""))
        if name == "chat":
            reply = F.to_json(F.struct(F.array(F.struct(F.struct(F.concat(F.lit("```json\n"), text, F.lit("\n```")).alias("content")).alias("message"), F.lit("stop").alias("finish_reason"))).alias("choices"), F.struct(F.col("output_tokens").alias("completion_tokens")).alias("usage")))
        else:
            reply = F.to_json(F.struct(F.array(F.struct(text.alias("text"))).alias("content"), F.lit("end_turn").alias("stop_reason"), F.struct(F.col("output_tokens").alias("output_tokens")).alias("usage")))
        f = backend.reply_fields(name, reply)
        body = backend.request_body(name, F.col("model_name"), F.lit("Be brief."), F.col("prompt"), 256)
        parts.append(c.select("call_id", F.lit(name).alias("provider"), F.size(F.from_json(F.get_json_object(body, "$.messages"), "array<string>")).alias("n_messages"), F.get_json_object(body, "$.system").alias("system"), F.md5(F.regexp_replace(f["content"], r"^\s+|\s+$", "")).alias("content_md5"), f["finish"].alias("finish"), f["output_tokens"].alias("output_tokens")))
    return parts[0].unionByName(parts[1])


def _design(prompts):
    out = []
    for p in prompts:
        ids = json.loads(p)
        if len(ids) % 10 == 9:
            raise ValueError("awkward size")
        out.append(json.dumps({"groups": [ids[: len(ids) // 2], ids[len(ids) // 2 :]]}))
    return out


def grouped_designs(spark, sf):
    """All samples of a chunk to one design; a chunk that fails carries its error."""
    c = _chunks(spark, sf).select("record_id", F.to_json(F.col("samples.geo_accession")).alias("p"))
    r = backend.run_backend(c, "record_id", "p", _design)
    return r.select("record_id", F.size(F.from_json(F.get_json_object("output", "$.groups[0]"), "array<string>")).alias("n_first"), F.size(F.from_json(F.get_json_object("output", "$.groups[1]"), "array<string>")).alias("n_second"), "error")


def model_matrix(spark, sf):
    """Every study under two models, one of which fails on studies of odd number."""

    def even(prompts):
        if any(int(p[3:]) % 2 for p in prompts):
            raise ValueError("odd")
        return [p[-2:] for p in prompts]

    s = _t(spark, sf, "studies").select("series_id")
    return backend.many_models(s, "series_id", "series_id", {"all": lambda ps: [p[-1:] for p in ps], "even": even})


def verbose_reruns(spark, sf):
    """Failed studies asked again with an instruction that the model needs."""

    def careful(prompts):
        if any(int(p[3:11]) % 3 == 0 and "explain" not in p for p in prompts):
            raise ValueError("unclear")
        return [f"{p[:11]} {len(p)}" for p in prompts]

    s = _t(spark, sf, "studies").select("series_id")
    done = materialize(backend.run_backend(s, "series_id", "series_id", careful), "first-run")
    return backend.rerun_failed(s, done, "series_id", "series_id", "explain each step", careful)


def end_to_end(spark, sf):
    """Bundle, run and collection of documents in one go: outputs, errors and the final status."""
    root = _root(spark, "extract")
    d = _t(spark, sf, "documents").select("doc_id", F.coalesce("source", F.lit("none")).alias("source"))
    bundles.write_bundle(spark, d, "doc_id", root, "run-1", "stage1", "p", {}, {"temperature": 0.2})
    inputs = spark.read.schema("doc_id long, source string").json(f"{root}/run-1/input")

    def loud(prompts):
        if "none" in prompts:
            raise ValueError("no source")
        return [p.upper() for p in prompts]

    out = backend.run_backend(inputs, "doc_id", "source", loud)
    resume.append_new(out, f"{root}/run-1/predictions", "doc_id")
    done = spark.read.parquet(f"{root}/run-1/predictions")
    counts = done.agg(F.count("output").alias("n_valid"), F.count("error").alias("n_errors")).first()
    bundles.replace_text(spark, f"{root}/run-1/status.json", json.dumps({"state": "collected", "n_valid": counts.n_valid}))
    state = json.loads(bundles.read_text(spark, f"{root}/run-1/status.json"))
    return done.groupBy("output", "error").agg(F.count("*").alias("n")).withColumn("state", F.lit(state["state"]))


def reject_file(spark, sf):
    """Rejected rows written as a table of text and counted by reason when read back."""
    root = _root(spark, "rejects")
    d = _t(spark, sf, "documents").select("doc_id", "source", X.reject_reason(F.col("lang"), F.col("source"), F.col("text"), "en", "study_summary", 600).alias("reason"))
    files.write_rejects(d.filter("reason is not null"), root, ["doc_id", "source", "reason"])
    return files.read_table(spark, root, ["doc_id", "reason"]).groupBy("reason").agg(F.count("*").alias("n"), F.count("source").alias("n_source"))


def csv_round_trip(spark, sf):
    """A sorted template of comma-separated text, null as empty text, read back under declared columns."""
    root = _root(spark, "csv")
    s = _t(spark, sf, "studies").select("series_id", "study_title", "srp")
    files.write_template(s, root, ["series_id"])
    back = files.read_table(spark, root, ["series_id", "study_title", "srp"], separator=",", null_text="")
    return back.select("series_id", "study_title", "srp")


def json_documents(spark, sf):
    """Studies written as one JSON array a file and read as whole documents, and as lines under strict reading."""
    root = _root(spark, "json")
    s = _t(spark, sf, "studies").select("series_id", "is_super_series")
    arrays = s.groupBy(F.substring("series_id", -1, 1).alias("d")).agg(F.to_json(F.sort_array(F.collect_list(F.struct("series_id", "is_super_series")))).alias("value"))
    # a file holds one array
    arrays.repartition("d").write.partitionBy("d").text(f"{root}/a")
    s.write.option("ignoreNullFields", False).json(f"{root}/l")
    whole = files.read_json_documents(spark, f"{root}/a", s.schema).select(*s.columns)
    lines = files.read_jsonl(spark, f"{root}/l", s.schema, strict=True)
    return whole.withColumn("form", F.lit("array")).unionByName(lines.withColumn("form", F.lit("lines"))).groupBy("form", "is_super_series").agg(F.count("*").alias("n"))


def shard_files(spark, sf):
    """Outputs written as three shards that overlap, put together by file name, the first row of an id kept."""
    root = _root(spark, "shards")
    d = _t(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("record_id"), "source")
    for k, keep in enumerate(["doc_id % 2 = 0", "doc_id % 3 = 0", "true"]):
        d.withColumn("doc_id", F.col("record_id").cast("long")).filter(keep).select("record_id", "source", F.lit(k).alias("shard")).write.json(f"{root}/s{k}")
    merged = files.read_shards(spark, f"{root}/s*", "record_id", path_order=True)
    return merged.groupBy(F.get_json_object("value", "$.shard").cast("int").alias("shard")).agg(F.count("*").alias("n"))


def stored_read_through(spark, sf):
    """Missing keys computed, checked and kept: a second call finds every valid key in the store."""
    root = _root(spark, "store")
    s = _t(spark, sf, "studies").select(F.col("series_id").alias("key"), "study_title")

    def compute(m):
        return m.select("key", F.length("payload").cast("string").alias("value"))

    wanted = s.select("key", F.coalesce("study_title", F.lit("")).alias("payload"))
    once = runs.stored_read_through(spark, wanted, root, compute, F.col("value") != "0")
    twice = runs.stored_read_through(spark, wanted, root, compute, F.col("value") != "0")
    return once.withColumn("call", F.lit(1)).unionByName(twice.withColumn("call", F.lit(2)))


def orchestrated(spark, sf):
    """Event files processed a few at a time until none is left, under a lock, with progress watched per chunk."""
    root = _root(spark, "loop")
    e = _t(spark, sf, "events").select("event_id", "event_type")
    e.repartition(6, "event_id").write.parquet(f"{root}/in")
    seen = resume.run_until_done(spark, f"{root}/in", e.schema, f"{root}/out", f"{root}/state", lambda b: b, "event_id", files_per_trigger=2, max_chunks=10)
    out = spark.read.parquet(f"{root}/out").groupBy("event_type").agg(F.count("*").alias("n"))
    return out.withColumn("state", F.lit(seen[-1]["state"])).withColumn("rows_seen", F.lit(sum(x["rows"] for x in seen)).cast("long"))


_LATEST_INPUT = f"{_SAMPLES}, x as (select geo_accession as record_id, series_id as series, sample_string as text from s)"
_OBJ = "coalesce(json_valid(raw_output) and json_type(case when json_valid(raw_output) then raw_output end) = 'OBJECT', false)"
_TOP = ["geo_accession", "series_id", "organism", "host_organism", "cell_context", "disease_state", "perturbations", "technical_treatments", "patient_metadata", "extraction"]
_CHUNK_SQL = f"""{_SAMPLES}, r as (select *, row_number() over (partition by series_id order by sha256('42:' || geo_accession), geo_accession) - 1 as rank, count(*) over (partition by series_id) as total from s where series_id is not null),
    c as (select series_id, rank // 50 as chunk, any_value((total + 49) // 50) as parts, any_value(total) as total, count(*) as n, list(geo_accession order by rank) as ids from r group by 1, 2),
    named as (select case when parts > 1 then series_id || '#' || (chunk + 1) else series_id end as record_id, * from c)"""
_RECORD = """'{"record_id":"' || record_id || '","ids":["' || array_to_string(ids, '","') || '"]'"""
_BYTES = f"strlen({_RECORD} || '}}') * 20"
_LIMIT = "case when b < 15360 then 4096 when b < 25600 then 8192 when b < 35840 then 16384 else 32768 end"

ORACLE_SQL = {
    "contract_breaches": f"""with f as (select fact_id, raw_output, json_keys(raw_output) as k from fact_records where {_OBJ}),
        m as (select fact_id, list_transform(list_filter({_TOP!r}, lambda x: not list_contains(k, x)), lambda x: 'missing ' || x) as m, list_transform(list_sort(list_distinct(list_filter(k, lambda x: not list_contains({_TOP!r}, x)))), lambda x: 'additional ' || x) as a from f)
        select fact_id, array_to_string(list_concat(m, a), '; ') as top_level from m
        union all select fact_id, '' from fact_records where json_valid(raw_output) and not {_OBJ}""",
    "contract_ids": f"""with g as (select fact_id, case when {_OBJ} then raw_output else '{{}}' end as j from fact_records)
        select fact_id, len(list_filter(json_type(j, '$.perturbations[*].agent_normalized.id'), lambda t: t not in ('VARCHAR', 'NULL')))::int as n_ids from g where json_type(j, '$.perturbations') = 'ARRAY' and n_ids > 0""",
    "strict_rates": "select worker_id, count(*) as n, round(avg(coalesce(json_valid(raw_output), false)::int), 6) as parse_rate, round(avg(coalesce(valid_schema, false)::int), 6) as recorded_rate from fact_records group by 1",
    "enriched_facts": f"""with {_LATEST_INPUT} select fact_id, case when x.record_id is not null then x.record_id else raw_output ->> '$.geo_accession' end as geo_accession, case when x.record_id is not null then series else raw_output ->> '$.series_id' end as series_id,
        case when x.record_id is not null then 'stage1.v3' else raw_output ->> '$.extraction.schema_version' end as schema_version, case when x.record_id is not null then 'mock:one' else raw_output ->> '$.extraction.model' end as model,
        case when x.record_id is not null then 'sha256:' || sha256(coalesce(text, '')) else raw_output ->> '$.extraction.raw_input_hash' end as raw_input_hash, (raw_output ->> '$.extraction.confidence')::double as confidence
        from fact_records f left join x on x.record_id = f.record_id where {_OBJ} and json_type(case when {_OBJ} then raw_output end, '$.extraction') = 'OBJECT'""",
    "collected_summary": f"select count(*) as n_rows, count(*) filter (coalesce(valid_schema, false)) as n_valid, count(*) filter (not coalesce(valid_schema, false)) as n_errors, count(*) filter ({_OBJ}) as n_parsed from fact_records",
    "failure_records": f"""with {_LATEST_INPUT} select fact_id, f.record_id as geo_accession, series as series_id, 'unclear' as context_kind, 0.0::double as confidence, 'metadata_inconsistency' as flags, 'sha256:' || sha256(coalesce(text, '')) as raw_input_hash, 0 as n_perturbations
        from fact_records f left join x using (record_id) where not coalesce(valid_schema, false)""",
    "enriched_designs": f"""with {_CHUNK_SQL} select record_id, series_id, 'a design' as design_summary, 'stage2.v2' as schema_version, 'mock:two' as model, n::int as input_sample_count, n % 2 = 1 as input_truncated, case when n % 2 = 1 then 0.5::double end as confidence from named""",
    "merged_status": """with e as (select user_id, event_type, ts, {'t': ts, 'i': event_id} as o, case event_type when 'signup' then 'queued' when 'view' then 'running' when 'click' then 'running' when 'purchase' then 'completed' else 'failed' end as state from events),
        st as (select user_id, arg_min(state, o) as state, min(ts) filter (state = 'running') as running_at, count(*) as n_total from e group by 1), sc as (select user_id, arg_max(state, o) as state from e where event_type in ('signup', 'view', 'click') group by 1),
        re as (select user_id, arg_max(state, o) as state, min(ts) as a, max(ts) as z, count(*) filter (event_type = 'purchase') as d, count(*) filter (event_type = 'error') as f from e where event_type in ('purchase', 'error') and user_id % 2 = 0 group by 1),
        m as (select st.*, re.state as rs, sc.state as ss, a, z, d, f, coalesce(re.state, sc.state, st.state) as cand from st left join re using (user_id) left join sc using (user_id)),
        n as (select *, case when state in ('completed', 'failed') and cand not in ('completed', 'failed') then state else cand end as nx from m), now as (select timestamp '2030-01-01 00:00:00' as now)
        select user_id, state as previous, nx as state, case when rs is not null then 'remote' when ss is not null then 'scheduler' else 'stored' end as source, state <> nx as changed,
        strftime(coalesce(a, running_at, case when nx = 'running' then now end), '%Y-%m-%d %H:%M:%S') as running_at, strftime(case when nx = 'completed' then coalesce(z, now) end, '%Y-%m-%d %H:%M:%S') as completed_at,
        strftime(case when nx = 'failed' then now end, '%Y-%m-%d %H:%M:%S') as failed_at, n_total, coalesce(d, 0) as n_done, coalesce(f, 0) as n_failed from n, now""",
    "bundle_parts": """select * from (values ('generation', '{"max_tokens": 4096, "temperature": 0.0}'), ('prompt', 'Read the text.'), ('status', '{"state": "completed"}'), ('events', 'created'), ('provenance', '14 ' || md5('Read the text.') || ' https://a.example/prompt prompt')) t(part, content)
        union all select 'handle', 'run-1 stage1 ' || count(*) || ' None' from documents union all select 'registry', 'run-1 created ' || count(*) || ' None' from documents union all select 'input', count(*) || ' ' || sum(doc_id) from documents""",
    "registry_log": "select case when event_type in ('view', 'click') then '(before)' else event_type end as event_type, count(*) as n, count(distinct user_id) as n_users from events group by 1",
    "newest_runs": """with f as (select coalesce(series_id, '(none)') as run_id, max(ts) filter (valid_schema) as t, bool_and(coalesce(valid_schema, false)) as ok from fact_records group by series_id)
        select run_id, case when t is null then 'failed' else 'running' end as state, strftime(t, '%Y-%m-%d %H:%M:%S') as "at" from f where not ok order by t desc nulls last, run_id limit 25""",
    "cached_lookups": """with k as (select distinct series_id, substr(series_id, 4)::bigint as n from studies), r as (select series_id, case when n % 7 <> 0 and n % 2 = 1 then 'summary of ' || series_id end as value, case when n % 7 = 0 then 'ValueError: no such study' end as error, n from k)
        select series_id, value, error, 'fetch' as source, 1 as round from r union all select series_id, value, error, case when n % 7 = 0 then 'fetch' else 'cache' end, 2 from r""",
    "super_flags": "select series_id, coalesce(study_summary like 'This SuperSeries is composed of%', false) as is_super, substr(study_summary, 1, 300) as head from studies",
    "paged_rows": "select (row_number() over () - 1)::bigint as node, 'node ' || (row_number() over () - 1) as name from studies",
    "label_groups": "select series_id, case when (substr(series_id, 4)::bigint - 70000000) // 2 between 0 and 2499 then (substr(series_id, 4)::bigint - 70000000) // 2 end as node from (select distinct series_id from studies)",
    "index_signatures": """with n as (select series_id as node, count(*)::int as n from samples where series_id is not null group by 1), f as (select node, n, trim(unnest(string_split(node, ','))) as series, generate_subscripts(string_split(node, ','), 1) as pos from n)
        select series, arg_min(n, {'a': node, 'b': pos}) as n_signatures from f where series <> '' group by 1""",
    "missing_by_study": f"""with {_LATEST_INPUT}, w as (select record_id, trim(string_split(series, ',')[1]) as series from x), d as (select f.record_id, w.series, coalesce(valid_schema, false) as ok from fact_records f join w using (record_id)),
        m as (select series, count(*) as n_missing from w where record_id not in (select record_id from d where ok) group by 1), seen as (select series, count(*) filter (ok) as p, bool_or(not ok) as e from d group by 1)
        select m.series, n_missing, coalesce(p, 0) as n_predictions, coalesce(e, false) as in_errors from m left join seen on seen.series = m.series""",
    "checked_union": "select ((length(geo_accession) + coalesce(length(series_id), 0)) % 3)::int as part, count(*) as n from samples group by 1",
    "moved_parts": "select fact_id, record_id, case when bool_and(coalesce(valid_schema, false)) over (partition by record_id) then 'resplit' else 'error' end as tag from fact_records",
    "curated_row": "select case when series_id = (select min(series_id) from studies) then 'CURATED' else coalesce(srp, '(null)') end as srp, count(*) as n from studies group by 1",
    "sibling_results": f"""with {_LATEST_INPUT}, f as (select fact_id, text, valid_schema from fact_records join x using (record_id)) select a.fact_id, min(b.fact_id) as copied_from from f a join f b on a.text = b.text where not a.valid_schema and b.valid_schema group by 1""",
    "long_outputs": "select fact_id, length(raw_output)::int as n from fact_records where length(raw_output) > 3500",
    "granular_roles": """with r as (select perturbation_id, case when is_negative_control then 'negative_inducer_control' when phase = 'washout' then 'baseline_t0' when phase = 'recovery' then 'secondary_arm' when temporal_order = 1 then 'bystander' else 'treated' end as k from perturbations)
        select perturbation_id, k as granularity_kind, case k when 'bystander' then 'bystander' when 'secondary_arm' then 'treated' else 'control' end as role from r where k <> 'treated'""",
    "record_limits": f"with {_CHUNK_SQL}, z as (select *, {_BYTES} as b from named) select record_id, md5({_RECORD} || ',\"max_tokens\":' || ({_LIMIT}) || '}}') as record_md5 from z",
    "run_limits": f"with {_CHUNK_SQL}, z as (select {_BYTES} as b from named), t as (select {_LIMIT} as m from z) select greatest(4096, max(m))::int as max_tokens, (case when max(m) >= 16384 then 65536 else 32768 end)::int as max_model_len, count(distinct m) as n_tiers from t",
    "model_costs": """with c as (select model_name, count(*) as n, sum(coalesce(input_tokens, 0) + 4 * coalesce(output_tokens, 0)) as u from resolver_calls group by 1), p(model_name, price) as (values ('mock-small', 0.2::double), ('mock-mid', 1.0), ('mock-large', 5.0))
        select c.model_name, n, round(u * price / 1000000, 6) as cost, round(u * price / n, 2) as cost_of_a_million from c left join p on p.model_name = c.model_name""",
    "schema_prompts": """select doc_id, md5('Name the role.' || chr(10) || chr(10) || 'Return exactly one JSON object matching this schema.' || chr(10) || '{
  "properties": {
    "role": {
      "type": "string"
    }
  },
  "required": [
    "role"
  ],
  "type": "object"
}' || chr(10) || chr(10) || 'Record ID: ' || doc_id || chr(10) || 'Record text:' || chr(10) || coalesce(text, '') || chr(10) || chr(10) || 'JSON:') as prompt_md5 from documents""",
    "study_prompts": f"""with {_CHUNK_SQL} select record_id, md5(concat_ws(chr(10), 'series_id: ' || c.series_id, case when parts > 1 then 'chunk: ' || (chunk + 1) || '/' || parts end, case when parts > 1 then 'study_total_samples: ' || total end, 'study_summary: ' || coalesce(study_summary, ''), 'samples:',
        '[' || array_to_string(list_transform(ids, lambda i: '{{"geo_accession":"' || i || '"}}'), ',') || ']')) as prompt_md5 from named c left join studies s on s.series_id = c.series_id""",
    "split_messages": "select call_id, concat_ws(chr(10) || chr(10), 'Be brief.', model_name) as system, 1 as n_rest from resolver_calls",
    "label_summaries": "select pair_key, count(*) as n, md5(string_agg(case_id || ' claude=' || coalesce(claude_choice, '-') || '; gpt=' || coalesce(gpt_choice, '-'), chr(10) order by case_id)) as overview_md5 from resolver_cases group by 1",
    "provider_round_trip": """select call_id, 'chat' as provider, 2 as n_messages, null::varchar as system, md5(regexp_replace(coalesce(reasoning, ''), '^\\s+|\\s+$', '', 'g')) as content_md5, 'stop' as finish, output_tokens::bigint as output_tokens from resolver_calls
        union all select call_id, 'blocks', 1, 'Be brief.', md5(regexp_replace(coalesce(reasoning, ''), '^\\s+|\\s+$', '', 'g')), 'end_turn', output_tokens::bigint from resolver_calls""",
    "grouped_designs": f"with {_CHUNK_SQL} select record_id, case when n % 10 = 9 then null else (n // 2)::int end as n_first, case when n % 10 = 9 then null else (n - n // 2)::int end as n_second, case when n % 10 = 9 then 'ValueError: awkward size' end as error from named",
    "model_matrix": """select series_id, 'all' as model, right(series_id, 1) as output, null::varchar as error from studies union all
        select series_id, 'even', case when substr(series_id, 4)::bigint % 2 = 0 then right(series_id, 2) end, case when substr(series_id, 4)::bigint % 2 = 1 then 'ValueError: odd' end from studies""",
    "verbose_reruns": "select series_id, series_id || ' ' || case when substr(series_id, 4)::bigint % 3 = 0 then length(series_id) + 19 else length(series_id) end as output, null::varchar as error from studies",
    "end_to_end": "select upper(source) as output, case when source is null then 'ValueError: no source' end as error, count(*) as n, 'collected' as state from documents group by 1, 2",
    "reject_file": """select case when lang is null or source is null then 'unknown' when lang <> 'en' then 'not_human' when source <> 'study_summary' then 'not_bulk_rnaseq' else 'string_too_short' end as reason, count(*) as n, count(source) as n_source
        from documents where not coalesce(lang = 'en' and source = 'study_summary' and length(text) >= 600, false) group by 1""",
    "csv_round_trip": "select series_id, nullif(study_title, '') as study_title, nullif(srp, '') as srp from studies",
    "json_documents": "select 'array' as form, is_super_series, count(*) as n from studies group by 1, 2 union all select 'lines', is_super_series, count(*) from studies group by 1, 2",
    "shard_files": "select (case when doc_id % 2 = 0 then 0 when doc_id % 3 = 0 then 1 else 2 end)::int as shard, count(*) as n from documents group by 1",
    "stored_read_through": """with k as (select series_id as key, length(coalesce(study_title, ''))::varchar as value from studies) select key, value, false as hit, 1 as call from k where value <> '0' union all select key, value, true, 2 from k where value <> '0'""",
    "orchestrated": "select event_type, count(*) as n, 'completed' as state, (select count(*) from events) as rows_seen from events group by 1",
}

QUERIES = {f.__name__: f for f in (
    contract_breaches, contract_ids, strict_rates, contract_report, enriched_facts, collected_summary, failure_records, enriched_designs, merged_status, bundle_parts, registry_log, newest_runs, cached_lookups, super_flags, paged_rows, label_groups,
    index_signatures, missing_by_study, checked_union, moved_parts, curated_row, sibling_results, long_outputs, granular_roles, record_limits, run_limits, model_costs, schema_prompts, study_prompts, split_messages, label_summaries, provider_round_trip,
    grouped_designs, model_matrix, verbose_reruns, end_to_end, reject_file, csv_round_trip, json_documents, shard_files, stored_read_through, orchestrated,
)}
