"""Queries of reports and samples: guards, alerts, coverage, first kinds, quotas, reviewed imports, keys of facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import FACT_SIGNATURE, fact_schema
from ..functions import text as X
from ..operators import backend, collection, evaluation, sampling, studies
from ..operators.contracts_check import import_reviewed
from ..operators.inlining import record_texts
from . import evaluation_queries as E
from . import study_queries as S
from .batch_queries import _SAMPLES, _samples


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def alert_groups(spark, sf):
    """Studies whose accuracy is below a half, the worst first."""
    m = evaluation.binary_metrics(E._labels(spark, sf), "gold", "predicted", "series_id")
    return m.filter(F.col("accuracy") < 0.5).select("series_id", "n", F.round("accuracy", 6).alias("accuracy")).orderBy("accuracy", "series_id")


def guarded_test(spark, sf):
    """Paired test per difference in days, only where there are 25 rows and both outcomes; else the reason."""
    j = E._judged(spark, sf).join(_t(spark, sf, "resolver_cases").select("case_id", "days_apart"), "case_id").filter("right_a is not null and right_b is not null")
    g = F.floor(F.abs("days_apart") / 30)
    m = j.groupBy(g.alias("months")).agg(F.count("*").alias("n"), F.count_if(F.col("right_a") & ~F.col("right_b")).alias("b"), F.count_if(~F.col("right_a") & F.col("right_b")).alias("c"))
    guard = F.when(F.col("n") < 25, "too few").when((F.col("b") == 0) | (F.col("c") == 0), "one-sided").otherwise("tested")
    chi = F.when(guard == "tested", F.round((F.col("b") - F.col("c")) * (F.col("b") - F.col("c")) / (F.col("b") + F.col("c")), 6))
    return m.select("months", "n", guard.alias("guard"), chi.alias("chi_square"))


def validity_rate(spark, sf):
    """Share of valid outputs; no rows are an error."""
    return evaluation.validity_rate(_t(spark, sf, "fact_records"), "valid_schema")


def disputed_agreement(spark, sf):
    """Cases with three labels or more: how often the majority is the first model's choice."""
    v = E._votes(spark, sf)
    d = v.groupBy("case_id").agg(F.count_distinct("label").alias("k")).filter("k >= 3").select("case_id")
    m = evaluation.majority(v, ["case_id"], "label").join(d, "case_id").join(_t(spark, sf, "resolver_cases").select("case_id", "claude_choice"), "case_id")
    return m.agg(F.count("*").alias("n"), F.round(F.avg((F.col("claude_choice") == F.col("majority")).cast("double")), 6).alias("rate"))


def coverage_rates(spark, sf):
    """Counts and rates by branch of the resolution, and by validity of the outputs."""
    b = studies.resolve_series(_t(spark, sf, "samples").select("geo_accession", "series_id"), "series_id", S._flags(spark, sf)).groupBy(F.col("branch").alias("value")).agg(F.count("*").alias("n")).withColumn("kind", F.lit("branch"))
    v = _t(spark, sf, "fact_records").groupBy(F.coalesce(F.col("valid_schema").cast("string"), F.lit("(null)")).alias("value")).agg(F.count("*").alias("n")).withColumn("kind", F.lit("valid"))
    both = b.unionByName(v)
    totals = both.groupBy("kind").agg(F.sum("n").alias("total"))
    return both.join(F.broadcast(totals), "kind").select("kind", "value", "n", F.round(F.col("n") / F.col("total"), 6).alias("rate"))


def first_kinds(spark, sf):
    """Kind of the first perturbation of strictly read facts, with labels of their own for none, an empty list and null."""
    f = _t(spark, sf, "fact_records").select(F.try_parse_json("raw_output").alias("v"), "raw_output").filter("v is not null")
    p = F.get_json_object("raw_output", "$.perturbations")
    kind = F.when(p.isNull(), "(no list)").when(F.regexp_replace(p, r"\s", "") == "[]", "(empty)").otherwise(F.coalesce(F.get_json_object("raw_output", "$.perturbations[0].kind"), F.lit("(null)")))
    return f.filter(F.ltrim("raw_output").startswith("{")).groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def worker_progress(spark, sf):
    """Rows, newest output and pending share of each worker against an even part of all samples."""
    f = _t(spark, sf, "fact_records").groupBy("worker_id").agg(F.count("*").alias("n"), F.max("ts").alias("newest"))
    total = _samples(spark, sf).count()
    per = -(-total // max(1, f.count()))
    return f.select("worker_id", "n", F.date_format("newest", "yyyy-MM-dd HH:mm:ss").alias("newest"), F.greatest(F.lit(per) - F.col("n"), F.lit(0)).cast("long").alias("n_pending")).orderBy("worker_id")


def first_roles(spark, sf):
    """Role of each sample by its first group, over all studies and chunks in order."""
    r = studies.sample_roles(S._designs(spark, sf), "first")
    return r.groupBy(F.col("sample").alias("geo_accession")).agg(F.min_by("role", "series_id").alias("role"))


def quota_sample(spark, sf):
    """Pinned rows, then quotas of each label, then hash order, up to 60."""
    s = _samples(spark, sf).select("geo_accession", F.coalesce(X.label_binary(F.col("gold")), F.lit("none")).alias("label"))
    return sampling.quota_sample(s, F.col("geo_accession").endswith("00"), "label", {"treated": 12, "control": 12, "none": 6}, 60, "geo_accession", 5)


def fixture_pick(spark, sf):
    """Two studies for each of four predicates, none twice."""
    s = _t(spark, sf, "studies").select("series_id", "is_super_series", "srp", "overall_design")
    k = F.when(F.col("is_super_series"), "super").when(F.col("srp").isNull(), "no_srp").when(F.col("overall_design").isNull(), "no_design").otherwise("plain")
    out = sampling.stratified(s.select("series_id", k.alias("kind")), "kind", {"super": 2, "no_srp": 2, "no_design": 2, "plain": 2}, "series_id", 9)
    return sampling.require_unique(out, "series_id").select("series_id", "kind")


def pair_weights(spark, sf):
    """Per branch: cases, pairs, and the share of cases in which the decision is the smaller study, each pair weighing its cases."""
    d = S.pair_decisions(spark, sf)
    per = d.groupBy("pair", "branch").agg(F.count("*").alias("w"), F.avg(F.col("rule_agrees").cast("double")).alias("a"))
    return per.groupBy("branch").agg(F.sum("w").alias("n_cases"), F.count("*").alias("n_pairs"), F.round(F.sum(F.col("w") * F.col("a")) / F.sum("w"), 6).alias("agree"))


def reviewed_import(spark, sf):
    """Reviewed labels: required columns, rows without label dropped, labels outside the vocabulary are an error."""
    s = _t(spark, sf, "samples").select("geo_accession", F.lower(F.trim("gold")).alias("gold"), "series_id")
    s = s.withColumn("gold", F.when(F.col("gold").isin("na", ""), None).otherwise(F.col("gold")))
    known = s.filter(F.col("gold").isNull() | F.col("gold").isin("treated", "control"))
    return import_reviewed(known, ["geo_accession", "gold"], "gold", ["treated", "control"]).groupBy("gold").agg(F.count("*").alias("n"))


def classified_rows(spark, sf):
    """Texts to facts by a batch function: failures become records that stand for them."""

    def classify(prompts):
        if any(p is None or "control" in p for p in prompts):
            raise ValueError("declined")
        return [p[:5] for p in prompts]

    s = _samples(spark, sf).select("geo_accession", "series_id", "sample_string")
    out = backend.run_backend(s, "geo_accession", "sample_string", classify).join(s, "geo_accession")
    r = collection.failure_record(F.col("geo_accession"), F.col("series_id"), F.col("sample_string"), "mock:one")
    return out.select("geo_accession", "output", F.when(F.col("error").isNotNull(), r["extraction"]["confidence"]).alias("confidence"), F.when(F.col("error").isNotNull(), r["cell_context"]["context_kind"]).alias("context_kind"), "error")


def _strict(spark, sf):
    """Strictly read facts whose lists are lists of objects."""
    f = _t(spark, sf, "fact_records").select("fact_id", "raw_output", collection.parsed_object(F.col("raw_output"), fact_schema()).alias("fact"))
    whole = lambda path, c: F.coalesce(F.get_json_object("raw_output", path).startswith("["), F.get_json_object("raw_output", path).isNull()) & ~F.exists(F.coalesce(c, F.array()), lambda x: x.isNull())
    return f.filter("fact is not null").filter(whole("$.perturbations", F.col("fact.perturbations")) & whole("$.cell_context.engineered_modifications", F.col("fact.cell_context.engineered_modifications")))


def fact_keys(spark, sf):
    """Agent, variant, status and kind of the first perturbation, the parts of the anchor."""
    f = _strict(spark, sf)
    first = F.get("fact.perturbations", F.lit(0))
    agent = first["agent_normalized"]
    return f.select(
        "fact_id", F.when(first.isNull(), "none").otherwise(X.agent_key(agent["id"], agent["id_database"], agent["preferred_name"])).alias("agent"), X.variant_key("fact.cell_context.engineered_modifications").alias("variant"),
        F.coalesce(F.nullif(F.col("fact.disease_state.status"), F.lit("")), F.lit("none")).alias("status"), X.kind_name(F.coalesce(first["kind"], F.lit("none"))).alias("kind"),
    )


def strict_anchors(spark, sf):
    """Thirteen-segment keys of strictly read facts under the role treated."""
    return _strict(spark, sf).select("fact_id", X.anchor_key("fact", F.lit("treated")).alias("anchor"))


def strict_inducers(spark, sf):
    """One row per mediated perturbation of strictly read facts."""
    p = _strict(spark, sf).select("fact_id", F.posexplode("fact.perturbations").alias("pos", "p")).filter("p.mediated_effect.kind is not null")
    return p.select("fact_id", "pos", F.coalesce("p.agent_normalized.preferred_name", "p.agent_raw", F.lit("unknown")).alias("inducer"), F.col("p.mediated_effect.kind").alias("kind"))


def _all_facts(spark, sf):
    """Every complete fact, however it is wrapped."""
    t = record_texts(_t(spark, sf, "fact_records"), "fact_id", "raw_output", FACT_SIGNATURE)
    return t.select("fact_id", F.from_json("record", fact_schema()).alias("fact"))


def anchor_keys(spark, sf):
    """Thirteen-segment keys of all facts that ``p1_facts`` finds; the strictly read ones in SQL as ``strict_anchors``."""
    return _all_facts(spark, sf).select("fact_id", X.anchor_key("fact", F.lit("treated")).alias("anchor"))


def inducer_log(spark, sf):
    """One row per mediated perturbation of all facts."""
    p = _all_facts(spark, sf).select("fact_id", F.posexplode("fact.perturbations").alias("pos", "p")).filter("p.mediated_effect.kind is not null")
    return p.select("fact_id", "pos", F.coalesce("p.agent_normalized.preferred_name", "p.agent_raw", F.lit("unknown")).alias("inducer"), F.col("p.mediated_effect.kind").alias("kind"), F.array_join("p.mediated_effect.targets", ",").alias("targets"))


_STRICT = """ok as (select fact_id, case when json_valid(raw_output) and json_type(case when json_valid(raw_output) then raw_output end) = 'OBJECT' then raw_output end as j from fact_records),
    facts as (select fact_id, j, case when json_type(j, '$.perturbations') = 'ARRAY' then j -> '$.perturbations' end as p, case when json_type(j, '$.cell_context.engineered_modifications') = 'ARRAY' then j -> '$.cell_context.engineered_modifications' end as m
    from ok where j is not null and (coalesce(json_type(j, '$.perturbations'), 'NULL') = 'NULL' or (json_type(j, '$.perturbations') = 'ARRAY' and len(list_filter(json_type(j, '$.perturbations[*]'), lambda t: t <> 'OBJECT')) = 0))
    and (coalesce(json_type(j, '$.cell_context.engineered_modifications'), 'NULL') = 'NULL' or (json_type(j, '$.cell_context.engineered_modifications') = 'ARRAY' and len(list_filter(json_type(j, '$.cell_context.engineered_modifications[*]'), lambda t: t <> 'OBJECT')) = 0))),
    k as (select *, case when len(p::json[]) > 0 then (p::json[])[1] end as f, list_filter(coalesce(m::json[], []), lambda x: (x ->> '$.variant.is_wildtype') = 'false' and coalesce((x ->> '$.variant.label') <> '', false)) as v from facts),
    parts as (select fact_id, j, f, p, case when f is null then 'none' when coalesce((f ->> '$.agent_normalized.id') <> '', false) then f ->> '$.agent_normalized.id'
    when coalesce((f ->> '$.agent_normalized.id_database') <> '', false) then (f ->> '$.agent_normalized.id_database') || ':' || coalesce(nullif(f ->> '$.agent_normalized.preferred_name', ''), 'unknown') else coalesce(nullif(f ->> '$.agent_normalized.preferred_name', ''), 'unknown') end as agent,
    case when len(v) > 0 then v[1] ->> '$.variant.label' else 'wt' end as variant, coalesce(nullif(j ->> '$.disease_state.status', ''), 'none') as status, f ->> '$.kind' as k0, len(coalesce(m::json[], [])) > 0 as engineered,
    f ->> '$.mediated_effect.kind' as mk, coalesce(len((case when json_type(f, '$.mediated_effect.targets') = 'ARRAY' then f -> '$.mediated_effect.targets' end)::json[]), 0) as nt, f ->> '$.mediated_effect.targets[0]' as t0,
    len(list_filter(coalesce(p::json[], []), lambda x: coalesce(x ->> '$.kind', 'unclear') not in ('none', 'vehicle_only', 'unclear'))) > 0 as active from k)"""
_NAMED = "case {0} when 'cytokine_stimulation' then 'cytokine_stim' when 'environmental_or_behavioral' then 'environmental' when 'mechanical_or_physical' then 'mechanical' else {0} end"
_ANCHOR = f"""a as (select *, status in ('case', 'comparison', 'disease_model') and not active as dis, mk is not null or nt > 0 as med, f ->> '$.dose.value_raw' as d, f ->> '$.duration.value_raw' as r,
    lower(regexp_replace(f ->> '$.duration.value_raw', '\\s+', '', 'g')) as t from parts), b as (select *, try_cast(regexp_extract(t, '^([0-9.]+)([a-z]+)$', 1) as double) as x, regexp_extract(t, '^([0-9.]+)([a-z]+)$', 2) as u from a)
    select fact_id, concat_ws('|', case when dis then 'disease_vs_normal' when med then {_NAMED.format("coalesce(mk, k0, 'unclear')")} else {_NAMED.format("coalesce(k0, 'none')")} end,
    case when dis then coalesce(nullif(j ->> '$.disease_state.mesh_id_candidate', ''), 'unknown') when med then 'HGNC:' || coalesce(nullif(t0, ''), 'unknown') else agent end, case when dis then 'wt' else variant end,
    case when coalesce(d <> '', false) then replace(regexp_replace(d, '\\s+', '', 'g'), chr(181), 'u') else 'nodose' end,
    case when coalesce(r = '', true) then 'na' when x is null then t when u in ('min', 'mins', 'minute', 'minutes') then printf('%.7g', x / 60) || 'h' when u in ('h', 'hr', 'hrs', 'hour', 'hours') then printf('%.7g', x) || 'h'
    when u in ('d', 'day', 'days') and x < 6 then printf('%.7g', x * 24) || 'h' when u in ('d', 'day', 'days') then printf('%.7g', x) || 'd' else t end, coalesce(f ->> '$.phase', 'exposure'),
    coalesce(nullif(j ->> '$.cell_context.cell_line_cellosaurus_candidate', ''), nullif(j ->> '$.cell_context.cell_type_or_line_raw', ''), 'unclear'), coalesce(j ->> '$.cell_context.context_kind', 'unclear'),
    coalesce(j ->> '$.cell_context.cell_state', 'proliferating'), coalesce(j ->> '$.cell_context.subcellular_fraction.kind', 'whole_cell'), coalesce(nullif(j ->> '$.cell_context.tissue', ''), 'na'), status, engineered::varchar) as anchor from b"""


def _oracle() -> dict[str, str]:
    from .evaluation_queries import _JUDGED, _VOTES, _metric_sql
    from .study_queries import ORACLE_SQL as STUDY
    from .study_queries import _PAIRS, _ROLES

    branch = STUDY["branch_counts"]
    return {
        "alert_groups": _metric_sql("series_id, n, round(accuracy, 6) as accuracy", "where accuracy < 0.5", key="null as kind, series_id,", group="group by series_id"),
        "guarded_test": f"""with {_JUDGED}, m as (select floor(abs(days_apart) / 30)::bigint as months, count(*) as n, count(*) filter (right_a and not right_b) as b, count(*) filter (not right_a and right_b) as c from judged join (select case_id, days_apart from resolver_cases) using (case_id)
            where right_a is not null and right_b is not null group by 1), g as (select *, case when n < 25 then 'too few' when b = 0 or c = 0 then 'one-sided' else 'tested' end as guard from m)
            select months, n, guard, case when guard = 'tested' then round((b - c) * (b - c) / (b + c), 6) end as chi_square from g""",
        "validity_rate": "select count(*) as n, round(avg(coalesce(valid_schema, false)::int), 6) as rate from fact_records",
        "disputed_agreement": f"""with {_VOTES}, d as (select case_id from votes group by 1 having count(distinct label) >= 3) select count(*) as n, round(avg((claude_choice = majority)::int), 6) as rate from major join d using (case_id) join resolver_cases using (case_id)""",
        "coverage_rates": f"""with b as ({branch}), u as (select 'branch' as kind, branch as value, n from b union all select 'valid', coalesce(valid_schema::varchar, '(null)'), count(*) from fact_records group by 2)
            select kind, value, n, round(n / sum(n) over (partition by kind), 6) as rate from u""",
        "first_kinds": """with f as (select case when json_valid(raw_output) and json_type(case when json_valid(raw_output) then raw_output end) = 'OBJECT' then raw_output end as j from fact_records)
            select case when coalesce(json_type(j, '$.perturbations'), 'NULL') = 'NULL' then '(no list)' when json_type(j, '$.perturbations') = 'ARRAY' and json_array_length(j, '$.perturbations') = 0 then '(empty)' else coalesce(j ->> '$.perturbations[0].kind', '(null)') end as kind, count(*) as n from f where j is not null group by 1""",
        "worker_progress": """with f as (select worker_id, count(*) as n, max(ts) as m from fact_records group by 1), p as (select ((select count(distinct geo_accession) from samples) + (select count(*) from f) - 1) // (select count(*) from f) as per)
            select worker_id, n, strftime(m, '%Y-%m-%d %H:%M:%S') as newest, greatest(per - n, 0)::bigint as n_pending from f, p""",
        "first_roles": f"with {_ROLES} select geo_accession, arg_min(role, series_id) as role from roles where series_id is not null group by 1",
        "quota_sample": f"""with {_SAMPLES}, x as (select geo_accession, coalesce(case lower(trim(gold)) when 'treated' then 'treated' when 'control' then 'control' end, 'none') as label, sha256('5:' || geo_accession) as h, geo_accession like '%00' as pin from s),
            q as (select *, row_number() over (partition by pin, label order by h, geo_accession) as r from x), o as (select *, case when pin then 0 when r <= case label when 'none' then 6 else 12 end then 1 else 2 end as step from q)
            select geo_accession, label, step::int as step from o order by step, h, geo_accession limit 60""",
        "fixture_pick": """with k as (select series_id, case when is_super_series then 'super' when srp is null then 'no_srp' when overall_design is null then 'no_design' else 'plain' end as kind from studies)
            select series_id, kind from k qualify row_number() over (partition by kind order by sha256('9:' || series_id), series_id) <= 2""",
        "pair_weights": f"""with {_PAIRS}, p as (select pair, branch, count(*) as w, avg((decision = low)::int) as a from d group by 1, 2) select branch, sum(w)::bigint as n_cases, count(*) as n_pairs, round(sum(w * a) / sum(w), 6) as agree from p group by 1""",
        "reviewed_import": "select lower(trim(gold)) as gold, count(*) as n from samples where lower(trim(gold)) in ('treated', 'control') group by 1",
        "classified_rows": f"""with {_SAMPLES}, x as (select geo_accession, sample_string, coalesce(sample_string not like '%control%', false) as ok from s)
            select geo_accession, case when ok then substr(sample_string, 1, 5) end as output, case when not ok then 0.0::double end as confidence, case when not ok then 'unclear' end as context_kind, case when not ok then 'ValueError: declined' end as error from x""",
        "fact_keys": f"with {_STRICT} select fact_id, agent, variant, status, {_NAMED.format('coalesce(k0, $$none$$)')} as kind from parts",
        "strict_anchors": f"with {_STRICT}, {_ANCHOR}",
        "strict_inducers": f"""with {_STRICT}, e as (select fact_id, unnest(p::json[]) as x, unnest(range(0, len(p::json[]))) as pos from parts where p is not null) select fact_id, pos::int as pos, coalesce(x ->> '$.agent_normalized.preferred_name', x ->> '$.agent_raw', 'unknown') as inducer, x ->> '$.mediated_effect.kind' as kind
            from e where x ->> '$.mediated_effect.kind' is not null""",
    }


QUERIES = {f.__name__: f for f in (
    alert_groups, guarded_test, validity_rate, disputed_agreement, coverage_rates, first_kinds, worker_progress, first_roles, quota_sample, fixture_pick, pair_weights, reviewed_import, classified_rows, fact_keys, strict_anchors, strict_inducers,
    anchor_keys, inducer_log,
)}
ORACLE_SQL = _oracle()
