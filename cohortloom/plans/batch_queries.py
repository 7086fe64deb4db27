"""Queries of batch runs: sampling, chunking, cache, registry, contracts, backends, streams, files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import backend, batching, records, runs, sampling
from ..operators.contracts_check import Rule, contract_errors, out_of_vocabulary, record_report
from ..sources import files
from ..streaming import resume
from ..workspace import shared_dir


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _samples(spark, sf):
    """One row per sample: the latest delivery."""
    s = _t(spark, sf, "samples").select("geo_accession", "series_id", "sample_string", "trtctr_ep", "gold", "loaded_at")
    return records.pick(s, ["geo_accession"], [F.col("loaded_at"), F.col("series_id")], last=True)


def stage_input(spark, sf):
    """Nested inputs of at most 50 samples in shuffled order."""
    c = batching.nested_chunks(_samples(spark, sf), "series_id", "geo_accession", ["geo_accession"], 50)
    return c.select("record_id", "n_samples", F.col("chunk_metadata.part").alias("part"), F.col("chunk_metadata.total_parts").alias("total_parts"), F.md5(F.array_join(F.col("samples.geo_accession"), ",")).alias("ids_md5"))


def rechunked_input(spark, sf):
    c = batching.rechunk(batching.nested_chunks(_samples(spark, sf), "series_id", "geo_accession", ["geo_accession"], 50), "record_id", "samples", 25)
    return c.select("record_id", F.size("samples").alias("n"), F.md5(F.array_join(F.col("samples.geo_accession"), ",")).alias("ids_md5"))


def greedy_plan(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "text", F.floor(F.col("doc_id") / 500).alias("file_id"))
    return batching.greedy_chunks(d, "file_id", "doc_id", "text", context_tokens=4096, prompt_tokens=300, reserve=60, max_records=12)


def greedy_members(spark, sf):
    """Record ids of each chunk, by joining the plan's ranges back."""
    d = _t(spark, sf, "documents").select("doc_id", F.floor(F.col("doc_id") / 500).alias("file_id"))
    ranked = batching.chunk_groups(d, "file_id", "doc_id", 1).select("file_id", "doc_id")
    plan = greedy_plan(spark, sf)
    per = ranked.groupBy("file_id").agg(F.array_sort(F.collect_list("doc_id")).alias("ids"))
    ids = F.slice("ids", F.col("start_index").cast("int"), F.col("record_count").cast("int"))
    return plan.join(per, "file_id").select("file_id", "chunk_id", F.md5(F.array_join(ids.cast("array<string>"), ",")).alias("ids_md5"))


def shards(spark, sf):
    return batching.round_robin(_t(spark, sf, "documents").select("doc_id"), "doc_id", 7).select("doc_id", "shard")


def interleaved(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", F.when(F.length("text") < 500, "S").when(F.length("text") < 1500, "M").otherwise("L").alias("tier"))
    return sampling.interleave(d, "tier", {"S": 5, "M": 4, "L": 1}, "doc_id", 7).select("doc_id", "tier", "cycle", "stratum_order", "rank")


def quartile_sample(spark, sf):
    n = _t(spark, sf, "samples").groupBy("series_id").agg(F.count("*").alias("n"))
    q = sampling.quartile_strata(n, "n")
    return sampling.stratified(q, "quartile", {f"Q{i}": 5 for i in (1, 2, 3, 4)}, "series_id", 42).select("series_id", "n", "quartile")


def dev_set(spark, sf):
    """Agreeing, disagreeing and short samples, 60 / 30 / 10; strata may overlap."""
    s = _samples(spark, sf)
    a, g = X.label_binary(F.col("trtctr_ep")), X.label_binary(F.col("gold"))
    parts = [("agree", s.filter(a == g), 60), ("disagree", s.filter(a != g), 30), ("short", s.filter(F.length("sample_string") <= 60), 10)]
    out = None
    for name, df, n in parts:
        p = sampling.top_by_hash(df.select("geo_accession"), n, "geo_accession", 42).withColumn("stratum", F.lit(name))
        out = p if out is None else out.unionByName(p)
    return out


def deficit_sample(spark, sf):
    s = _samples(spark, sf).select("geo_accession", X.design_kind(F.concat_ws(" ", "sample_string", "trtctr_ep")).alias("kind"))
    s = s.withColumn("kind", F.when(F.col("kind") == "unknown", "treatment_vs_vehicle").otherwise(F.col("kind")))
    return sampling.stratified(s, "kind", {"time_course": 15, "knockdown_panel": 10, "factorial": 8, "treatment_vs_vehicle": 20}, "geo_accession", 42, fallback="treatment_vs_vehicle").select("geo_accession", "kind")


def pinned_sample(spark, sf):
    """Pinned rows first, then hash order, up to 40."""
    s = _samples(spark, sf).select("geo_accession")
    pinned = s.filter(F.col("geo_accession").endswith("00"))
    return pinned.withColumn("pin", F.lit(0)).unionByName(s.join(pinned, "geo_accession", "left_anti").withColumn("pin", F.lit(1))).orderBy("pin", sampling.hash_order(42, "geo_accession")).limit(40).select("geo_accession", "pin")


def tiered_sample(spark, sf):
    """Ten studies of each tier first, then twenty of their samples, each study with one at least."""
    s = _samples(spark, sf).filter(F.col("series_id").isNotNull())
    n = s.groupBy("series_id").agg(F.count("*").alias("n")).withColumn("tier", F.when(F.col("n") >= 40, "easy").otherwise("hard"))
    groups = sampling.stratified(n, "tier", {"easy": 5, "hard": 5}, "series_id", 3)
    pool = s.join(groups.select("series_id", "tier"), "series_id").select("geo_accession", "series_id", "tier")
    h = sampling.hash_order(3, "geo_accession")
    seeds = pool.groupBy("series_id", "tier").agg(F.min(F.struct(h.alias("h"), "geo_accession")).alias("m")).select(F.col("m.geo_accession").alias("geo_accession"), "series_id", "tier", F.lit(0).alias("o"))
    rest = pool.join(seeds.select("geo_accession"), "geo_accession", "left_anti").withColumn("o", F.lit(1))
    return seeds.unionByName(rest.select(*seeds.columns)).orderBy("o", h).limit(20).select("geo_accession", "series_id", "tier")


def smoke_pick(spark, sf):
    f = _t(spark, sf, "fact_records").select("fact_id", X.failure_mode(F.col("raw_output")).alias("mode"))
    return sampling.stratified(f, "mode", {"A": 15, "B": 5, "other": 10}, "fact_id", 1)


def _event_log(spark, sf):
    e = _t(spark, sf, "events")
    return e.select(F.concat_ws(":", "user_id", "event_type").alias("key"), F.col("props").alias("value"), F.col("ts").alias("put_at"), "event_id")


def cache_latest(spark, sf):
    return runs.latest(_event_log(spark, sf), tie="event_id").select("key", "value", "event_id")


def cache_statistics(spark, sf):
    return runs.cache_stats(_event_log(spark, sf))


def cache_files(spark, sf):
    """Puts the whole log to a namespace in two appends and reads the latest of all keys back."""
    log, root = _event_log(spark, sf).select("key", "value", "put_at", "event_id"), f"{shared_dir(spark)}/cohortloom/cache-{uuid.uuid4().hex}"
    for k in (0, 1):
        runs.cache_put(log.filter(F.pmod(F.coalesce("event_id", F.lit(0)), F.lit(2)) == k), root, "events")
    return runs.cache_get(spark, root, "events", log.select("key")).select("key", "value")


def read_through(spark, sf):
    e = _event_log(spark, sf)
    log = e.filter(F.col("event_id") % 2 == 0)
    wanted = e.select("key", F.col("key").alias("payload"))
    return runs.read_through(wanted, log.select("key", F.sha2("key", 256).alias("value"), "put_at"), lambda m: m.select("key", F.sha2("payload", 256).alias("value")))


def run_registry(spark, sf):
    f = _t(spark, sf, "fact_records").select("series_id", F.struct("ts", "fact_id").alias("at"), F.when(F.col("fact_id") % 3 != 0, F.col("worker_id")).alias("worker"), F.when(F.col("valid_schema"), F.col("record_id")).alias("last_valid"))
    return runs.run_upsert(f, "series_id", "at").select("series_id", "worker", "last_valid", F.col("at.fact_id").alias("last_fact"))


_STATES = {"signup": "PENDING", "view": "RUNNING", "click": "COMPLETING", "purchase": "COMPLETED", "error": "NODE_FAIL+"}


def _states(spark, sf):
    e = _t(spark, sf, "events")
    raw = F.create_map(*[F.lit(x) for kv in _STATES.items() for x in kv])[F.col("event_type")]
    # now and then a purchase is collected
    state = F.when((F.col("event_type") == "purchase") & (F.col("event_id") % 4 == 0), "collected").otherwise(runs.scheduler_state(raw))
    return e.select("user_id", "ts", "event_id", state.alias("state"))


def scheduler_states(spark, sf):
    return _states(spark, sf).groupBy("state").agg(F.count("*").alias("n"))


def run_states(spark, sf):
    return runs.stable_state(_states(spark, sf), "user_id", ["ts", "event_id"], "state")


def run_progress(spark, sf):
    f = _t(spark, sf, "fact_records").groupBy("worker_id").agg(F.count_if("valid_schema").alias("done"), F.count_if(~F.col("valid_schema")).alias("failed"), F.max("fact_id").alias("newest"))
    p = runs.progress(F.lit(200), F.col("done"), F.col("failed"))
    return f.select("worker_id", "done", "failed", "newest", p["n_pending"].cast("long").alias("n_pending"), F.round(p["share_done"], 6).alias("share_done"))


def job_times(spark, sf):
    plan = greedy_plan(spark, sf).groupBy("file_id").agg(F.count("*").alias("chunks"), F.sum("record_count").alias("records"), F.sum("estimated_tokens").alias("tokens"))
    e = runs.job_seconds(F.col("chunks"), F.col("records"), F.col("tokens"))
    return plan.select("file_id", e.alias("seconds"), X.clock_text(e).alias("clock"), runs.time_status(F.lit(600), e).alias("status"), (F.ceil(e / 300) * 300).alias("suggested"))


def _broken_props(spark, sf):
    e = _t(spark, sf, "events").select("event_id", "props")
    k = F.col("event_id") % 5
    raw = F.when(k == 1, F.expr("substr(props, 1, length(props) - 1)")).when(k == 2, F.expr("substr(props, 1, length(props) - 1) || ', \"x\": 1}'")).when(k == 3, F.lit('{"k": "seven"}')).when(k == 4, F.lit("{}")).otherwise(F.col("props"))
    return e.select("event_id", raw.alias("raw"))


def contract_check(spark, sf):
    errors = contract_errors(F.col("raw"), [Rule("k", ("integer",), minimum=0, maximum=60)], parsed=F.col("v"))
    checked = _broken_props(spark, sf).withColumn("v", F.try_parse_json("raw")).select("event_id", F.array_join(errors, "; ").alias("errors"))
    return checked.select("event_id", "errors", (F.col("errors") == "").alias("valid"))


def contract_rates(spark, sf):
    return contract_check(spark, sf).groupBy("errors").agg(F.count("*").alias("n"))


def tolerant_props(spark, sf):
    raw = F.concat(F.lit("Here it is: "), F.col("raw"), F.lit(" (end)"))
    return _broken_props(spark, sf).select("event_id", F.get_json_object(X.tolerant_json(raw), "$.k").alias("k"))


def compact_json(spark, sf):
    p = _t(spark, sf, "perturbations").select("perturbation_id", "dose.value_raw", "dose.unit")
    return p.select("perturbation_id", F.length(F.to_json(F.struct("value_raw", "unit"), {"ignoreNullFields": "false"})).alias("n_chars"))


def records_input(spark, sf):
    return record_report(_t(spark, sf, "samples"), "geo_accession")


def unknown_labels(spark, sf):
    return out_of_vocabulary(_t(spark, sf, "samples"), "gold", ["treated", "control"])


def bundle_manifest(spark, sf):
    return files.bundle_manifest(_t(spark, sf, "documents"), "doc_id", "text")


def mock_backend(spark, sf):
    d = _t(spark, sf, "documents")
    r = backend.mock_reply(F.col("doc_id"), F.col("text"), ["7", "70", "700"], as_json=False)
    return d.select("doc_id", F.md5(r["output"]).alias("output_md5"), r["error"].alias("error"))


def batch_backend(spark, sf):
    """A batch function at the end of the plan; documents without a language fail and are isolated."""

    def generate(prompts):
        if any(p is None for p in prompts):
            raise ValueError("no prompt")
        return [p[:20].upper() for p in prompts]

    d = _t(spark, sf, "documents").select("doc_id", F.when(F.col("lang").isNotNull(), F.concat("lang", F.lit(":"), "source")).alias("p"))
    return backend.run_backend(d, "doc_id", "p", generate).select("doc_id", "output", "error")


def reply_classes(spark, sf):
    f = _t(spark, sf, "fact_records")
    finish = F.when(F.col("fact_id") % 10 == 0, "length").otherwise("stop")
    return f.groupBy(backend.reply_class(finish, F.col("raw_output")).alias("class")).agg(F.count("*").alias("n"))


def stream_once(spark, sf):
    """Every event is processed once over two starts of the stream; counts by type of the appended target."""
    root = f"{shared_dir(spark)}/cohortloom/stream-{uuid.uuid4().hex}"
    events = _t(spark, sf, "events").select("event_id", "event_type")
    for k in (0, 1):
        # the second start finds the first half again, with the rest
        part = events if k else events.filter(F.col("event_id") % 2 == 0)
        part.write.mode("append").parquet(f"{root}/in")
        resume.run_resumable(spark, f"{root}/in", events.schema, f"{root}/out", f"{root}/state", lambda b: b.withColumn("size", F.length("event_type")), "event_id", files_per_trigger=64)
    return spark.read.parquet(f"{root}/out").groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("n_ids"))


def hourly_events(spark, sf):
    """Extension: counts per event-time window."""
    w = resume.windowed_counts(_t(spark, sf, "events"), "ts", "event_type", "6 hours")
    return w.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n")


def side_outputs(spark, sf):
    """Rows by predicate written as JSON lines and counted when read back."""
    root = f"{shared_dir(spark)}/cohortloom/split-{uuid.uuid4().hex}"
    s = _t(spark, sf, "studies").select("series_id", "srp", "is_super_series")
    files.write_split(s, root, {"super": "is_super_series", "no_srp": "srp is null", "other": "not is_super_series and srp is not null"})
    out = None
    for name in ("super", "no_srp", "other"):
        df = files.read_jsonl(spark, f"{root}/{name}", s.schema).agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
        out = df if out is None else out.unionByName(df)
    return out


def text_round_trip(spark, sf):
    """Samples written as tab-separated text and read back with declared columns and the null marker."""
    path = f"{shared_dir(spark)}/cohortloom/tsv-{uuid.uuid4().hex}"
    s = _t(spark, sf, "samples").select("geo_accession", "series_id", "trtctr_ep", "gold")
    s.write.option("sep", "\t").option("header", True).option("nullValue", "NA").option("emptyValue", "").csv(path)
    back = files.read_table(spark, path, ["geo_accession", "gold"])
    return back.groupBy(F.coalesce("gold", F.lit("(null)")).alias("gold")).agg(F.count("*").alias("n"))


_SAMPLES = "s as (select geo_accession, series_id, sample_string, trtctr_ep, gold from samples qualify row_number() over (partition by geo_accession order by loaded_at desc nulls last, series_id desc nulls last, sample_string desc nulls last, trtctr_ep desc nulls last, gold desc nulls last) = 1)"
_H = "sha256('42:' || geo_accession)"
_CHUNKS = f"""{_SAMPLES}, r as (select *, row_number() over (partition by series_id order by {_H}, geo_accession) - 1 as rank, count(*) over (partition by series_id) as total from s),
    c as (select series_id, rank // 50 as chunk, any_value((total + 49) // 50) as parts, count(*) as n, list(geo_accession order by rank) as ids from r group by 1, 2),
    named as (select case when parts > 1 then series_id || '#' || (chunk + 1) else series_id end as record_id, * from c)"""
_PLAN = """costs as (select doc_id // 500 as file_id, doc_id, greatest(1, ceil(strlen(coalesce(text, '')) / 4))::bigint + 60 as cost, row_number() over (partition by doc_id // 500 order by doc_id) as i from documents),
    walk as (select file_id, i, 1 as chunk_id, case when 300 + cost > 2867 then 300 + cost else 300 + cost end as total, 1 as cnt, 300 + cost > 2867 as over from costs where i = 1
    union all select c.file_id, c.i, case when w.over or w.total + c.cost > 2867 or w.cnt + 1 > 12 then w.chunk_id + 1 else w.chunk_id end,
    case when w.over or w.total + c.cost > 2867 or w.cnt + 1 > 12 then 300 + c.cost else w.total + c.cost end, case when w.over or w.total + c.cost > 2867 or w.cnt + 1 > 12 then 1 else w.cnt + 1 end,
    case when w.over or w.total + c.cost > 2867 or w.cnt + 1 > 12 then 300 + c.cost > 2867 else false end from walk w join costs c on c.file_id = w.file_id and c.i = w.i + 1),
    plan as (select file_id, chunk_id::bigint as chunk_id, min(i) as start_index, max(i) as end_index, count(*) as record_count, max(total)::bigint as estimated_tokens, bool_or(over) as oversize from walk group by 1, 2)"""
_LOG = "log as (select user_id || ':' || event_type as key, props as value, ts as put_at, event_id from events)"
_KIND_SQL = "case when k in ('unknown') then 'treatment_vs_vehicle' else k end"
_STATE_SQL = """st as (select user_id, ts, event_id, case when event_type = 'purchase' and event_id % 4 = 0 then 'collected' else case event_type when 'signup' then 'queued' when 'view' then 'running' when 'click' then 'running' when 'purchase' then 'completed' else 'failed' end end as state
    from events)"""
_RAW = """raw as (select event_id, case event_id % 5 when 1 then substr(props, 1, length(props) - 1) when 2 then substr(props, 1, length(props) - 1) || ', "x": 1}' when 3 then '{"k": "seven"}' when 4 then '{}' else props end as raw, event_id % 5 as m, (props ->> '$.k')::int as k from events)"""
_ERRORS = """errs as (select event_id, case m when 1 then 'not an object' when 2 then 'additional: x' || case when k > 60 then '; maximum: k' else '' end when 3 then 'type: k' when 4 then 'missing: k' else case when k > 60 then 'maximum: k' else '' end end as errors from raw)"""


def _oracle() -> dict[str, str]:
    from .text_queries import _KIND

    label = "case lower(trim({0})) when 'treated' then 'treated' when 'control' then 'control' end"
    return {
        "stage_input": f"with {_CHUNKS} select record_id, n as n_samples, chunk + 1 as part, parts as total_parts, md5(array_to_string(ids, ',')) as ids_md5 from named",
        "rechunked_input": f"""with {_CHUNKS}, p as (select record_id, ids, (len(ids) + 24) // 25 as parts, unnest(range(1, (len(ids) + 24) // 25 + 1)) as k from named)
            select record_id || '--rsc' || k || 'of' || parts as record_id, len(ids[(k - 1) * 25 + 1 : k * 25])::int as n, md5(array_to_string(ids[(k - 1) * 25 + 1 : k * 25], ',')) as ids_md5 from p""",
        "greedy_plan": f"with recursive {_PLAN} select * from plan",
        "greedy_members": f"with recursive {_PLAN} select file_id, chunk_id, md5(string_agg(doc_id::varchar, ',' order by doc_id)) as ids_md5 from plan join costs using (file_id) where i between start_index and end_index group by 1, 2",
        "shards": "select doc_id, ((row_number() over (order by doc_id) - 1) % 7)::int as shard from documents",
        "interleaved": """with t as (select doc_id, case when length(text) < 500 then 'S' when length(text) < 1500 then 'M' else 'L' end as tier from documents), r as (select *, row_number() over (partition by tier order by sha256('7:' || doc_id), doc_id) - 1 as rank from t)
            select doc_id, tier, rank // (case tier when 'S' then 5 when 'M' then 4 else 1 end) as cycle, (case tier when 'S' then 0 when 'M' then 1 else 2 end)::int as stratum_order, rank from r""",
        "quartile_sample": """with n as (select series_id, count(*) as n from samples group by 1), c as (select quantile_cont(n, 0.25) as a, quantile_cont(n, 0.5) as b, quantile_cont(n, 0.75) as d from n),
            q as (select series_id, n, case when n <= a then 'Q1' when n <= b then 'Q2' when n <= d then 'Q3' else 'Q4' end as quartile from n, c) select * from q qualify row_number() over (partition by quartile order by sha256('42:' || series_id), series_id) <= 5""",
        "dev_set": f"""with {_SAMPLES}, x as (select geo_accession, {label.format('trtctr_ep')} as a, {label.format('gold')} as g, sample_string from s) select * from (select geo_accession, 'agree' as stratum from x where a = g order by {_H} limit 60)
            union all select * from (select geo_accession, 'disagree' from x where a <> g order by {_H} limit 30) union all select * from (select geo_accession, 'short' from x where length(sample_string) <= 60 order by {_H} limit 10)""",
        "deficit_sample": f"""with {_SAMPLES}, k as (select geo_accession, {_KIND} as k from (select *, concat_ws(' ', sample_string, trtctr_ep) as t from s)), p as (select geo_accession, {_KIND_SQL} as kind from k),
            w(kind, target) as (values ('time_course', 15), ('knockdown_panel', 10), ('factorial', 8), ('treatment_vs_vehicle', 20)), have as (select w.kind, target, count(p.kind) as n from w left join p using (kind) group by 1, 2),
            lack as (select sum(greatest(0, target - n)) as d from have where kind <> 'treatment_vs_vehicle')
            select geo_accession, kind from (select p.*, target + case when kind = 'treatment_vs_vehicle' then d else 0 end as t, row_number() over (partition by kind order by {_H}, geo_accession) as r from p join have using (kind), lack) where r <= t""",
        "pinned_sample": f"with {_SAMPLES} select geo_accession, (geo_accession not like '%00')::int as pin from s order by pin, {_H} limit 40",
        "tiered_sample": f"""with {_SAMPLES}, n as (select series_id, count(*) as n, case when count(*) >= 40 then 'easy' else 'hard' end as tier from s where series_id is not null group by 1),
            g as (select * from n qualify row_number() over (partition by tier order by sha256('3:' || series_id), series_id) <= 5), p as (select geo_accession, series_id, tier, row_number() over (partition by series_id order by sha256('3:' || geo_accession)) as r from s join g using (series_id))
            select geo_accession, series_id, tier from p order by r > 1, sha256('3:' || geo_accession) limit 20""",
        "smoke_pick": """with f as (select fact_id, case when coalesce(length(tail) - length(replace(tail, chr(9), '')) >= 20, false) then 'A' when coalesce(length(raw_output) >= 2400 and not regexp_matches(raw_output, '[\\s.]{30}'), false) then 'B' else 'other' end as mode
            from (select *, substr(raw_output, greatest(1, length(raw_output) - 50), 51) as tail from fact_records)) select * from f qualify row_number() over (partition by mode order by sha256('1:' || fact_id), fact_id) <= case mode when 'A' then 15 when 'B' then 5 else 10 end""",
        "cache_latest": f"with {_LOG} select key, value, event_id from log qualify row_number() over (partition by key order by put_at desc, event_id desc) = 1",
        "cache_statistics": f"with {_LOG} select count(*) as n_entries, count(distinct key) as n_keys from log",
        "cache_files": f"with {_LOG} select key, value from log qualify row_number() over (partition by key order by put_at desc) = 1",
        "read_through": f"with {_LOG} select key, sha256(key) as value, bool_or(event_id % 2 = 0) as hit from log group by 1",
        "run_registry": """select series_id, arg_max(worker_id, {'t': ts, 'f': fact_id}) filter (fact_id % 3 <> 0) as worker, arg_max(record_id, {'t': ts, 'f': fact_id}) filter (valid_schema) as last_valid, arg_max(fact_id, {'t': ts, 'f': fact_id}) as last_fact from fact_records group by 1""",
        "scheduler_states": f"with {_STATE_SQL} select state, count(*) as n from st group by 1",
        "run_states": f"""with {_STATE_SQL} select user_id, list_reduce(list(state order by ts, event_id), lambda a, b: case when a = 'collected' and b = 'completed' then a
            when a in ('completed', 'failed', 'cancelled', 'collected') and b not in ('completed', 'failed', 'cancelled', 'collected') then a else b end) as state, count(*) as n_events from st group by 1""",
        "run_progress": """select worker_id, count(*) filter (valid_schema) as done, count(*) filter (not valid_schema) as failed, max(fact_id) as newest, greatest(200 - count(valid_schema), 0)::bigint as n_pending, round(count(valid_schema) / 200, 6) as share_done from fact_records group by 1""",
        "job_times": f"""with recursive {_PLAN}, t as (select file_id, greatest(300, ceil((90 + count(*) * 20 + sum(record_count) * 1.5 + sum(estimated_tokens) / 350 + 60) * 1.2))::bigint as e from plan group by 1)
            select file_id, e as seconds, printf('%02d:%02d:%02d', e // 3600, (e // 60) % 60, e % 60) as clock, case when 600 < e * 0.8 then 'too_low' when 600 > greatest(e * 3, e + 7200) then 'suspiciously_high' else 'ok' end as status, (ceil(e / 300) * 300)::bigint as suggested from t""",
        "contract_check": f"with {_RAW}, {_ERRORS} select event_id, errors, errors = '' as valid from errs",
        "contract_rates": f"with {_RAW}, {_ERRORS} select errors, count(*) as n from errs group by 1",
        "tolerant_props": f"with {_RAW} select event_id, case m when 1 then null when 3 then 'seven' when 4 then null else k::varchar end as k from raw",
        "compact_json": """select perturbation_id, (length(to_json({'value_raw': dose.value_raw, 'unit': dose.unit})::varchar))::int as n_chars from perturbations""",
        "records_input": "select count(*) as n_rows, count(*) filter (geo_accession is null or trim(geo_accession) = '') as n_blank, count(geo_accession) - count(distinct geo_accession) as n_repeated from samples",
        "unknown_labels": "select gold, count(*) as n_rows from samples where gold not in ('treated', 'control') group by 1",
        "bundle_manifest": "select count(*) as n_records, count(distinct doc_id) as n_ids, sum(strlen(coalesce(text, '')))::bigint as n_bytes, max(strlen(coalesce(text, '')))::int as max_bytes from documents",
        "mock_backend": "select doc_id, case when doc_id not in (7, 70, 700) then md5(substr(coalesce(text, ''), 1, 80)) end as output_md5, case when doc_id in (7, 70, 700) then 'forced failure' end as error from documents",
        "batch_backend": "select doc_id, case when lang is not null and source is not null then upper(substr(lang || ':' || source, 1, 20)) end as output, case when lang is null or source is null then 'ValueError: no prompt' end as error from documents",
        "reply_classes": """select case when fact_id % 10 = 0 then 'truncated' when coalesce(trim(raw_output), '') = '' then 'empty' when not json_valid(raw_output) then 'not_json' else 'ok' end as class, count(*) as n from fact_records group by 1""",
        "stream_once": "select event_type, count(*) as n, count(distinct event_id) as n_ids from events group by 1",
        "hourly_events": "select strftime(time_bucket(interval '6 hours', ts, timestamp '1970-01-01'), '%Y-%m-%d %H:%M:%S') as window_start, event_type, count(*) as n from events group by 1, 2",
        "side_outputs": "select 'super' as part, count(*) as n from studies where is_super_series union all select 'no_srp', count(*) from studies where srp is null union all select 'other', count(*) from studies where not is_super_series and srp is not null",
        "text_round_trip": "select coalesce(nullif(nullif(gold, 'NA'), ''), '(null)') as gold, count(*) as n from samples group by 1",
    }


QUERIES = {f.__name__: f for f in (
    stage_input, rechunked_input, greedy_plan, greedy_members, shards, interleaved, quartile_sample, dev_set, deficit_sample, pinned_sample, tiered_sample, smoke_pick, cache_latest, cache_statistics, cache_files,
    read_through, run_registry, scheduler_states, run_states, run_progress, job_times, contract_check, contract_rates, tolerant_props, compact_json, records_input, unknown_labels, bundle_manifest, mock_backend,
    batch_backend, reply_classes, stream_once, hourly_events, side_outputs, text_round_trip,
)}
ORACLE_SQL = _oracle()
