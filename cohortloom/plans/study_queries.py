"""Queries over studies and records: resolution, lookups, groups, comparisons, merges, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import batching, records, studies


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _flags(spark, sf):
    return _t(spark, sf, "studies").select("series_id", "is_super_series", "srp").select("series_id", F.coalesce("is_super_series", F.lit(False)).alias("is_super"), X.filled(F.col("srp")).alias("has_srp"))


def resolved_series(spark, sf):
    s = _t(spark, sf, "samples").select("geo_accession", "series_id", "loaded_at")
    return studies.resolve_series(s, "series_id", _flags(spark, sf)).select("geo_accession", "series_id", F.date_format("loaded_at", "yyyyMMddHHmmss").alias("loaded"), "resolved", "branch")


def branch_counts(spark, sf):
    s = studies.resolve_series(_t(spark, sf, "samples").select("geo_accession", "series_id"), "series_id", _flags(spark, sf))
    return s.groupBy("branch").agg(F.count("*").alias("n"), F.count_distinct("resolved").alias("n_series"))


def pair_decisions(spark, sf):
    c = _t(spark, sf, "resolver_cases").select("case_id", "primary_gse", "secondary_gse")
    f = _flags(spark, sf)
    a, b = f.select(F.col("series_id").alias("primary_gse"), F.col("has_srp").alias("sa"), F.col("is_super").alias("ua")), f.select(F.col("series_id").alias("secondary_gse"), F.col("has_srp").alias("sb"), F.col("is_super").alias("ub"))
    c = c.join(a, "primary_gse", "left").join(b, "secondary_gse", "left")
    no = F.lit(False)
    d = studies.pair_decision(c, "primary_gse", "secondary_gse", F.coalesce("sa", no), F.coalesce("sb", no))
    return d.select("case_id", X.pair_key(F.col("primary_gse"), F.col("secondary_gse")).alias("pair"), studies.case_type(F.col("ua"), F.col("ub")).alias("case_type"), "branch", "decision", "tiebreak_used", "rule_agrees")


def pair_summary(spark, sf):
    d = pair_decisions(spark, sf)
    return d.groupBy("branch", "case_type").agg(F.count("*").alias("n"), F.round(F.avg(F.col("rule_agrees").cast("double")), 6).alias("agree"), F.count_if("tiebreak_used").alias("n_tiebreak"))


def days_apart(spark, sf):
    c = _t(spark, sf, "resolver_cases").select("case_id", "primary_gse", "secondary_gse")
    s = _t(spark, sf, "studies").select("series_id", "submitted_at")
    out = c.join(s.select(F.col("series_id").alias("primary_gse"), F.col("submitted_at").alias("a")), "primary_gse").join(s.select(F.col("series_id").alias("secondary_gse"), F.col("submitted_at").alias("b")), "secondary_gse")
    return out.select("case_id", F.datediff("b", "a").alias("days"))


def shared_samples(spark, sf):
    """Containment and Jaccard of the sample sets of studies that share samples; pairs arise within a sample's own short list."""
    s = _t(spark, sf, "samples").select("geo_accession", F.explode(F.array_distinct(X.split_list(F.col("series_id")))).alias("gse")).distinct()
    sizes = s.groupBy("gse").agg(F.count("*").alias("n"))
    lists = _t(spark, sf, "samples").filter(F.col("series_id").contains(",")).select("geo_accession", F.array_sort(F.array_distinct(X.split_list(F.col("series_id")))).alias("l")).distinct()
    a = lists.select("geo_accession", "l", F.posexplode("l").alias("i", "gse_a"))
    pairs = a.select("geo_accession", "gse_a", F.explode(F.slice("l", F.col("i") + 2, F.size("l"))).alias("gse_b")).distinct().groupBy("gse_a", "gse_b").agg(F.count("*").alias("n_both"))
    out = pairs.join(sizes.select(F.col("gse").alias("gse_a"), F.col("n").alias("n_a")), "gse_a").join(sizes.select(F.col("gse").alias("gse_b"), F.col("n").alias("n_b")), "gse_b")
    return out.select("gse_a", "gse_b", "n_both", F.round(F.col("n_both") / F.col("n_a"), 6).alias("a_in_b"), F.round(F.col("n_both") / F.col("n_b"), 6).alias("b_in_a"), F.round(F.col("n_both") / (F.col("n_a") + F.col("n_b") - F.col("n_both")), 6).alias("jaccard"))


def cascade_lookup(spark, sf):
    ref = _t(spark, sf, "ref_terms")
    synonyms = ref.select(F.explode(X.split_list(F.col("synonyms"), r"\|")).alias("name"), F.col("ref_id").alias("entry"))
    names = [ref.select(F.col("preferred_name").alias("name"), F.col("ref_id").alias("entry")), synonyms, ref.select(F.col("ref_id").alias("name"), F.col("ref_id").alias("entry"))]
    needles = _t(spark, sf, "cell_contexts").select(F.explode(F.array("cell_type_or_line_raw", "cell_line_cellosaurus_candidate", "term_raw")).alias("needle"))
    return records.first_hit(needles, "needle", names)


def _roles(spark, sf):
    s = _t(spark, sf, "samples").select("series_id", "geo_accession", F.coalesce(X.label_binary(F.col("trtctr_ep")), F.lit("unclear")).alias("role"), "loaded_at")
    return records.pick(s, ["series_id", "geo_accession"], [F.col("loaded_at"), F.col("role")], last=True)


def _designs(spark, sf):
    """Designs of bounded size: each chunk of at most 50 samples of a study, grouped by role."""
    c = batching.chunk_groups(_roles(spark, sf), "series_id", "geo_accession", 50)
    c = c.select(F.concat("series_id", F.lit("#"), "chunk").alias("series_id"), "geo_accession", "role", "rank")
    ids = F.transform(F.sort_array(F.collect_list(F.struct("rank", "geo_accession"))), lambda x: x["geo_accession"])
    g = c.groupBy("series_id", "role").agg(ids.alias("sample_ids"))
    groups = F.sort_array(F.collect_list(F.struct(F.col("role").alias("group_id"), "role", "sample_ids"))).alias("groups")
    pair = F.array(F.struct(F.lit("c1").alias("comparison_id"), F.lit("treated").alias("treated"), F.lit("control").alias("control")), F.struct(F.lit("c2").alias("comparison_id"), F.lit("unclear").alias("treated"), F.lit("control").alias("control")))
    return g.groupBy("series_id").agg(groups).withColumn("pairs", pair)


def role_map(spark, sf):
    return studies.sample_roles(_designs(spark, sf), "last").select(X.base_id(F.col("series_id")).alias("series_id"), F.col("sample").alias("geo_accession"), "role")


def role_map_first(spark, sf):
    """Roles of a sample over studies and chunks: the first in order counts."""
    r = _roles(spark, sf)
    return r.groupBy("geo_accession").agg(F.min_by("role", F.struct("series_id")).alias("role"), F.count("*").alias("n_series"))


def _first_perturbation(spark, sf):
    p = _t(spark, sf, "perturbations").select("perturbation_id", "geo_accession", "pert_kind", "agent_raw")
    return p.groupBy("geo_accession").agg(F.min_by(F.struct("pert_kind", "agent_raw"), "perturbation_id").alias("m")).select("geo_accession", F.concat_ws("|", X.kind_name(F.col("m.pert_kind")), F.coalesce("m.agent_raw", F.lit("unknown"))).alias("anchor"))


def comparison_table(spark, sf):
    f = _first_perturbation(spark, sf).withColumnRenamed("geo_accession", "sample")
    c = studies.comparisons(_designs(spark, sf), f)
    return c.select("series_id", "comparison_id", "treated_role", "representative", "n_samples_treated", "n_samples_control", "anchor")


def shared_anchors(spark, sf):
    """Keys that occur in two studies or more."""
    p = _t(spark, sf, "perturbations").select("series_id", F.concat_ws("|", X.kind_name(F.col("pert_kind")), "agent_raw").alias("anchor"))
    return p.groupBy("anchor").agg(F.count_distinct("series_id").alias("n_series"), F.count("*").alias("n")).filter("n_series >= 2")


def ordinal_group_labels(spark, sf):
    p = _t(spark, sf, "perturbations").filter(F.col("temporal_order").isNotNull()).select("series_id", F.col("temporal_order").cast("string").alias("group_key"), F.array("geo_accession").alias("sample_ids"))
    return studies.ordinal_labels(p)


def group_texts(spark, sf):
    """Per study: rows, distinct labels in order, and the first label."""
    s = _t(spark, sf, "samples").select("series_id", "geo_accession", F.lower(F.trim("trtctr_ep")).alias("label"))
    d = s.groupBy("series_id").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("label")), " || ").alias("labels"), F.min_by(F.coalesce("label", F.lit("(null)")), F.struct("geo_accession", "label")).alias("first_label"))
    return d.filter("n >= 2")


def latest_samples(spark, sf):
    s = _t(spark, sf, "samples").select("geo_accession", "series_id", "trtctr_ep", "loaded_at")
    out = records.pick(s, ["geo_accession"], [F.col("loaded_at"), F.col("series_id"), F.col("trtctr_ep")], last=True)
    return out.select("geo_accession", "series_id", "trtctr_ep", F.date_format("loaded_at", "yyyyMMddHHmmss").alias("loaded"))


def earliest_facts(spark, sf):
    f = _t(spark, sf, "fact_records").select("record_id", "fact_id", "ts", "valid_schema")
    return records.pick(f, ["record_id"], [F.col("ts"), F.col("fact_id")]).select("record_id", "fact_id", "valid_schema")


def patched_samples(spark, sf):
    base = records.pick(_t(spark, sf, "samples").select("geo_accession", "gold", "treat", "loaded_at"), ["geo_accession"], [F.col("loaded_at"), F.col("treat"), F.col("gold")])
    facts = _t(spark, sf, "cell_contexts").filter(F.col("disease_status").isNotNull()).groupBy("geo_accession").agg(F.max("disease_status").alias("gold"))
    return records.overlay(base.drop("loaded_at"), facts, "geo_accession", ["gold"], "patch")


def quarantined_studies(spark, sf):
    return records.quarantine(_t(spark, sf, "fact_records"), "series_id", ~F.col("valid_schema"), least=2, share=0.05)


def facts_outside_quarantine(spark, sf):
    f = _t(spark, sf, "fact_records").select("fact_id", "series_id", "valid_schema")
    return f.join(quarantined_studies(spark, sf).select("series_id"), "series_id", "left_anti").groupBy("valid_schema").agg(F.count("*").alias("n"))


def whole_groups(spark, sf):
    f = _t(spark, sf, "fact_records").groupBy("series_id").agg(F.bool_and("valid_schema").alias("whole"), F.count("*").alias("n"))
    return f.filter("whole").select("series_id", "n")


def valid_invalid(spark, sf):
    ok, bad = records.split_validity(_t(spark, sf, "fact_records").select("fact_id", "valid_schema"), F.col("valid_schema"))
    return ok.agg(F.count("*").alias("n")).select(F.lit("valid").alias("part"), "n").unionByName(bad.agg(F.count("*").alias("n")).select(F.lit("invalid").alias("part"), "n"))


def merged_runs(spark, sf):
    """Reruns over the main run: the later source wins a record, sources are counted."""
    f = _t(spark, sf, "fact_records").select("record_id", "fact_id", "worker_id", "valid_schema")
    main = records.pick(f.filter("worker_id % 2 = 0"), ["record_id"], [F.col("fact_id")]).drop("worker_id")
    rescue = records.pick(f.filter("worker_id % 2 = 1 and valid_schema"), ["record_id"], [F.col("fact_id")])
    return records.priority_union([("main", 0, main), ("rescue", 1, rescue)], "record_id").select("record_id", "fact_id", "source", "worker_id")


def run_sources(spark, sf):
    return merged_runs(spark, sf).groupBy("source").agg(F.count("*").alias("n"), F.count("worker_id").alias("n_worker"))


def once_per_series(spark, sf):
    s = _t(spark, sf, "samples").select("geo_accession", "series_id", "sample_string").filter("sample_string is not null")
    out = records.once_per_key(s, "series_id", {"first_id": F.trim(F.split("series_id", ",")[0]), "digest": F.md5("series_id")})
    return out.groupBy("first_id", "digest").agg(F.count("*").alias("n"))


def pending_records(spark, sf):
    s = _t(spark, sf, "samples").select(F.col("geo_accession").alias("record_id")).distinct()
    return s.join(_t(spark, sf, "fact_records").select("record_id").distinct(), "record_id", "left_anti")


def known_series_rows(spark, sf):
    s = _t(spark, sf, "samples").select("geo_accession", "series_id", "sample_string").filter(F.col("series_id").rlike("^GSE[0-9]+$"))
    return s.join(_t(spark, sf, "studies").filter("not is_super_series").select("series_id"), "series_id", "left_semi").groupBy("series_id").agg(F.count("*").alias("n"))


def series_of_records(spark, sf):
    f = _t(spark, sf, "fact_records").select("fact_id", "record_id", "series_id")
    s = latest_samples(spark, sf).select(F.col("geo_accession").alias("record_id"), F.col("series_id").alias("sample_series"))
    return f.join(s, "record_id", "left").select("fact_id", F.coalesce("sample_series", "series_id", "record_id").alias("series"))


def enriched_texts(spark, sf):
    s = latest_samples(spark, sf).select("geo_accession", F.trim(F.split("series_id", ",")[0]).alias("series_id"), "trtctr_ep")
    st = _t(spark, sf, "studies").select("series_id", "study_title", "srp")
    return s.join(st, "series_id", "left").select("geo_accession", X.composed_text(F.col("study_title"), F.col("srp"), F.col("trtctr_ep")).alias("text"))


def accession_sets(spark, sf):
    a = _t(spark, sf, "samples").select("geo_accession").distinct()
    b = _t(spark, sf, "perturbations").select("geo_accession").distinct()
    parts = [("union", a.union(b).distinct()), ("intersect", a.intersect(b)), ("except", a.subtract(b)), ("bag_union", a.unionByName(b))]
    out = None
    for name, df in parts:
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("operation"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def padded_union(spark, sf):
    a = _t(spark, sf, "samples").select("geo_accession", "gold")
    b = _t(spark, sf, "cell_contexts").select("geo_accession", "tissue")
    return a.unionByName(b, allowMissingColumns=True).groupBy(F.col("gold").isNull().alias("no_gold"), F.col("tissue").isNull().alias("no_tissue")).agg(F.count("*").alias("n"))


_FLAGS = "flags as (select series_id, coalesce(is_super_series, false) as sup, coalesce(srp <> '', false) as srp from studies)"
_RESOLVED = f"""{_FLAGS}, parts as (select l, pos, gse, coalesce(sup, false) as sup, coalesce(srp, false) as srp, try_cast(replace(gse, 'GSE', '') as double) as num from
    (select l, unnest(range(1, len(p) + 1)) as pos, unnest(p) as gse from (select l, list_filter(list_transform(string_split(l, ','), lambda x: trim(x)), lambda x: x <> '') as p from (select distinct series_id as l from samples where series_id is not null))) left join flags on series_id = gse),
    agg as (select l, count(*) as n, count(*) filter (not sup) as k, count(*) filter (not sup and srp) as s, arg_min(gse, pos) as first_id, arg_min(gse, pos) filter (not sup) as first_open, arg_min(srp, pos) filter (not sup) as first_has,
    arg_min(gse, pos) filter (not sup and srp) as first_srp, arg_min(gse, num) filter (not sup) as smallest from parts group by 1),
    res as (select l, case when n = 1 then first_id when k = 1 then first_open when k = 0 then first_id when s = 1 then first_srp else smallest end as resolved,
    case when n = 1 then 'single_gse' when k = 1 then 'clean_super_scarted' when k = 0 then 'all_super_pathological' when k = 2 and s = 2 then 'tiebreak_both_srp' when k = 2 and s = 0 then 'fallback_no_srp'
    when k = 2 and first_has then 'srp_a_only' when k = 2 then 'srp_b_only' when s = 1 then 'srp_one_of_many' else 'multi_gse_multi_branch' end as branch from agg)"""
_PAIRS = f"""{_FLAGS}, x as (select case_id, primary_gse a, secondary_gse b, coalesce(fa.srp, false) sa, coalesce(fb.srp, false) sb, fa.sup ua, fb.sup ub,
    case when try_cast(replace(primary_gse, 'GSE', '') as double) < try_cast(replace(secondary_gse, 'GSE', '') as double) then primary_gse else secondary_gse end as low
    from resolver_cases left join flags fa on fa.series_id = primary_gse left join flags fb on fb.series_id = secondary_gse),
    d as (select case_id, least(a, b) || '|' || greatest(a, b) as pair, case when ua is null or ub is null then 'other' when ua and ub then 'all_super' when ua or ub then 'clean' else 'ambiguous' end as case_type,
    case when sa and not sb then 'srp_a_only' when sb and not sa then 'srp_b_only' when sa and sb then 'both_srp' else 'no_srp' end as branch, case when sa and not sb then a when sb and not sa then b else low end as decision, sa = sb as tiebreak_used, low from x)"""
_LABEL = "case lower(trim(trtctr_ep)) when 'treated' then 'treated' when 'control' then 'control' else 'unclear' end"
_ROLES = f"""roles as (select series_id, geo_accession, {_LABEL} as role from samples qualify row_number() over (partition by series_id, geo_accession order by loaded_at desc, {_LABEL} desc) = 1)"""
_CHUNKED = f"""{_ROLES}, ranked as (select *, row_number() over (partition by series_id order by sha256('42:' || geo_accession), geo_accession) - 1 as rank from roles),
    grp as (select series_id || '#' || (rank // 50) as sid, role, count(*) as n, arg_min(geo_accession, rank) as rep from ranked group by 1, 2)"""
_KINDS = "case pert_kind when 'cytokine_stimulation' then 'cytokine_stim' when 'environmental_or_behavioral' then 'environmental' when 'mechanical_or_physical' then 'mechanical' else pert_kind end"
_LATEST = "latest as (select geo_accession, series_id, trtctr_ep, loaded_at from samples qualify row_number() over (partition by geo_accession order by loaded_at desc nulls last, series_id desc nulls last, trtctr_ep desc nulls last) = 1)"
_QUAR = "quar as (select series_id, count(*) filter (not valid_schema) as n_bad, count(*) as n_rows from fact_records group by 1 having count(*) filter (not valid_schema) >= 2 and count(*) filter (not valid_schema) >= 0.05 * count(*))"
_MERGED = """parts as (select record_id, fact_id, null::int as worker_id, 'main' as source, 0 as p from (select * from fact_records where worker_id % 2 = 0 qualify row_number() over (partition by record_id order by fact_id) = 1)
    union all select record_id, fact_id, worker_id, 'rescue', 1 from (select * from fact_records where worker_id % 2 = 1 and valid_schema qualify row_number() over (partition by record_id order by fact_id) = 1)),
    merged as (select record_id, fact_id, source, worker_id from parts qualify row_number() over (partition by record_id order by p desc) = 1)"""

QUERIES = {f.__name__: f for f in (
    resolved_series, branch_counts, pair_decisions, pair_summary, days_apart, shared_samples, cascade_lookup, role_map, role_map_first, comparison_table, shared_anchors, ordinal_group_labels, group_texts, latest_samples,
    earliest_facts, patched_samples, quarantined_studies, facts_outside_quarantine, whole_groups, valid_invalid, merged_runs, run_sources, once_per_series, pending_records, known_series_rows,
    series_of_records, enriched_texts, accession_sets, padded_union,
)}

ORACLE_SQL = {
    "resolved_series": f"with {_RESOLVED} select geo_accession, series_id, strftime(loaded_at, '%Y%m%d%H%M%S') as loaded, resolved, coalesce(branch, 'no_series') as branch from samples left join res on series_id = l",
    "branch_counts": f"with {_RESOLVED} select coalesce(branch, 'no_series') as branch, count(*) as n, count(distinct resolved) as n_series from samples left join res on series_id = l group by 1",
    "pair_decisions": f"with {_PAIRS} select case_id, pair, case_type, branch, decision, tiebreak_used, decision = low as rule_agrees from d",
    "pair_summary": f"with {_PAIRS} select branch, case_type, count(*) as n, round(avg((decision = low)::int), 6) as agree, count(*) filter (tiebreak_used) as n_tiebreak from d group by 1, 2",
    "days_apart": "select case_id, datediff('day', a.submitted_at::date, b.submitted_at::date)::int as days from resolver_cases join studies a on a.series_id = primary_gse join studies b on b.series_id = secondary_gse",
    "shared_samples": """with m as (select distinct geo_accession, trim(unnest(string_split(series_id, ','))) as gse from samples), s as (select gse, count(*) as n from m where gse <> '' group by 1),
        p as (select a.gse as gse_a, b.gse as gse_b, count(distinct a.geo_accession) as n_both from (select distinct geo_accession, series_id as l, trim(unnest(string_split(series_id, ','))) as gse from samples) a
        join (select distinct geo_accession, series_id as l, trim(unnest(string_split(series_id, ','))) as gse from samples) b on a.geo_accession = b.geo_accession and a.l = b.l and a.gse < b.gse group by 1, 2)
        select gse_a, gse_b, n_both, round(n_both / x.n, 6) as a_in_b, round(n_both / y.n, 6) as b_in_a, round(n_both / (x.n + y.n - n_both), 6) as jaccard from p join s x on x.gse = gse_a join s y on y.gse = gse_b""",
    "cascade_lookup": """with d as (select lower(preferred_name) as n, 0 as p, ref_id from ref_terms union all select lower(trim(unnest(string_split(synonyms, '|')))), 1, ref_id from ref_terms union all select lower(ref_id), 2, ref_id from ref_terms),
        b as (select n, p, ref_id from d where n <> '' qualify row_number() over (partition by n order by p, ref_id) = 1),
        k as (select distinct needle from (select cell_type_or_line_raw as needle from cell_contexts union all select cell_line_cellosaurus_candidate from cell_contexts union all select term_raw from cell_contexts) where needle is not null)
        select needle, ref_id as entry, p::int as resolved_via from k left join b on lower(needle) = n""",
    "role_map": f"with {_ROLES} select series_id, geo_accession, role from roles",
    "role_map_first": f"with {_ROLES} select geo_accession, arg_min(role, series_id) as role, count(*) as n_series from roles group by 1",
    "comparison_table": f"""with {_CHUNKED}, p as (select geo_accession, {_KINDS} || '|' || coalesce(agent_raw, 'unknown') as anchor from perturbations qualify row_number() over (partition by geo_accession order by perturbation_id) = 1)
        select t.sid as series_id, c.id as comparison_id, t.role as treated_role, t.rep as representative, t.n::int as n_samples_treated, coalesce(k.n, 0)::int as n_samples_control, anchor
        from (values ('c1', 'treated'), ('c2', 'unclear')) c(id, treated) join grp t on t.role = c.treated left join grp k on k.sid = t.sid and k.role = 'control' join p on p.geo_accession = t.rep""",
    "shared_anchors": f"select concat_ws('|', {_KINDS}, agent_raw) as anchor, count(distinct series_id) as n_series, count(*) as n from perturbations group by 1 having count(distinct series_id) >= 2",
    "ordinal_group_labels": """with m as (select series_id, geo_accession, temporal_order as k, max(temporal_order) over (partition by series_id) as last from perturbations where temporal_order is not null)
        select series_id, geo_accession as sample, case when min(k) = any_value(last) then 'control' else 'treated' end as label from m group by 1, 2""",
    "group_texts": """select series_id, count(*) as n, coalesce(string_agg(distinct l, ' || ' order by l), '') as labels, arg_min(coalesce(l, '(null)'), {'a': geo_accession, 'b': coalesce(l, '')}) as first_label from (select *, lower(trim(trtctr_ep)) as l from samples) group by 1 having count(*) >= 2""",
    "latest_samples": f"with {_LATEST} select geo_accession, series_id, trtctr_ep, strftime(loaded_at, '%Y%m%d%H%M%S') as loaded from latest",
    "earliest_facts": "select record_id, fact_id, valid_schema from fact_records qualify row_number() over (partition by record_id order by ts nulls first, fact_id) = 1",
    "patched_samples": """with b as (select geo_accession, gold, treat from samples qualify row_number() over (partition by geo_accession order by loaded_at nulls first, treat nulls first, gold nulls first) = 1),
        p as (select geo_accession, max(disease_status) as g from cell_contexts where disease_status is not null group by 1)
        select geo_accession, case when g is not null then g else gold end as gold, treat, case when g is not null then 'patch' else 'base' end as source from b left join p using (geo_accession)""",
    "quarantined_studies": f"with {_QUAR} select * from quar",
    "facts_outside_quarantine": f"with {_QUAR} select valid_schema, count(*) as n from fact_records f where not exists (select 1 from quar q where q.series_id = f.series_id) group by 1",
    "whole_groups": "select series_id, count(*) as n from fact_records group by 1 having bool_and(valid_schema)",
    "valid_invalid": "select case when coalesce(valid_schema, false) then 'valid' else 'invalid' end as part, count(*) as n from fact_records group by 1",
    "merged_runs": f"with {_MERGED} select record_id, fact_id, source, worker_id from merged",
    "run_sources": f"with {_MERGED} select source, count(*) as n, count(worker_id) as n_worker from merged group by 1",
    "once_per_series": "select trim(string_split(series_id, ',')[1]) as first_id, md5(series_id) as digest, count(*) as n from samples where sample_string is not null group by 1, 2",
    "pending_records": "select distinct geo_accession as record_id from samples where geo_accession not in (select record_id from fact_records)",
    "known_series_rows": "select series_id, count(*) as n from samples where regexp_matches(series_id, '^GSE[0-9]+$') and series_id in (select series_id from studies where not is_super_series) group by 1",
    "series_of_records": f"with {_LATEST} select fact_id, coalesce(l.series_id, f.series_id, record_id) as series from fact_records f left join latest l on l.geo_accession = record_id",
    "enriched_texts": f"""with {_LATEST} select geo_accession, concat_ws(',', case when coalesce(study_title <> '', false) then 'title: ' || study_title end, case when coalesce(srp <> '', false) then 'source: ' || srp end, case when coalesce(trtctr_ep <> '', false) then trtctr_ep end) as text
        from latest l left join studies s on s.series_id = trim(string_split(l.series_id, ',')[1])""",
    "accession_sets": """with a as (select distinct geo_accession from samples), b as (select distinct geo_accession from perturbations) select 'union' as operation, count(*) as n from (from a union from b) union all select 'intersect', count(*) from (from a intersect from b)
        union all select 'except', count(*) from (from a except from b) union all select 'bag_union', count(*) from (from a union all from b)""",
    "padded_union": "select gold is null as no_gold, tissue is null as no_tissue, count(*) as n from (select gold, null as tissue from samples union all select null, tissue from cell_contexts) group by 1, 2",
}
