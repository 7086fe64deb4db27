"""Queries over texts: composition, classification, canonical forms, hashes, prompts, broken JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def composed_text(spark, sf):
    return _t(spark, sf, "studies").select("series_id", X.composed_text(F.col("study_title"), F.col("srp"), F.col("overall_design")).alias("text"))


def reject_counts(spark, sf):
    d = _t(spark, sf, "documents").select("lang", "source", "text")
    reason = X.reject_reason(F.col("lang"), F.col("source"), F.col("text"), "en", "study_summary", 600)
    return d.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def keyword_label(spark, sf):
    s = _t(spark, sf, "samples")
    return s.groupBy(X.label_binary(F.col("trtctr_ep")).alias("gold"), X.control_label(F.col("trtctr")).alias("predicted")).agg(F.count("*").alias("n"))


def keyword_kind(spark, sf):
    s = _t(spark, sf, "samples").select("geo_accession", "loaded_at", F.concat_ws(" ", "sample_string", "trtctr").alias("t"))
    return s.select("geo_accession", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss").alias("loaded"), X.design_kind(F.col("t")).alias("kind"))


def keyword_kind_documents(spark, sf):
    d = _t(spark, sf, "documents")
    return d.groupBy("source", X.design_kind(F.translate("text", "\n\r", "  ")).alias("kind")).agg(F.count("*").alias("n"))


def dose_duration_keys(spark, sf):
    p = _t(spark, sf, "perturbations")
    return p.select("perturbation_id", X.dose_key(F.col("dose.value_raw")).alias("dose_key"), X.duration_key(F.col("duration.value_raw")).alias("duration_key"))


def cell_and_kind_keys(spark, sf):
    c = _t(spark, sf, "cell_contexts")
    return c.select("context_id", X.cell_key(F.col("cell_line_cellosaurus_candidate"), F.col("cell_type_or_line_raw")).alias("cell_key"))


def kind_names(spark, sf):
    p = _t(spark, sf, "perturbations")
    return p.groupBy(X.kind_name(F.col("pert_kind")).alias("kind")).agg(F.count("*").alias("n"))


def hash_keys(spark, sf):
    s = _t(spark, sf, "samples").select("geo_accession", "series_id", "sample_string").filter(F.col("sample_string").isNotNull()).distinct()
    return s.select("geo_accession", X.cache_key("v3", F.col("sample_string")).alias("cache_key"), X.seed_of(F.col("series_id"), 42).alias("seed"))


def slugs(spark, sf):
    s = _t(spark, sf, "studies")
    run = F.concat_ws("-", F.lit("20260101T000000Z"), X.slug(F.col("study_title")), F.substring(F.md5("series_id"), 1, 6))
    return s.select("series_id", X.slug(F.col("study_title")).alias("slug"), run.alias("run_id"), X.short_run_id(run).alias("short_id"), X.base_id(F.concat("series_id", F.lit("#2--rsc1of3"))).alias("base_id"))


def first_of_list(spark, sf):
    s = _t(spark, sf, "samples")
    return s.groupBy(F.trim(F.split("series_id", ",")[0]).alias("canonical")).agg(F.count("*").alias("n"), F.sum(F.size(X.split_list(F.col("series_id"))).cast("long")).alias("n_ids"))


def failure_modes(spark, sf):
    f = _t(spark, sf, "fact_records")
    return f.select("fact_id", X.failure_mode(F.col("raw_output")).alias("mode"), X.scraped_field(F.col("raw_output"), "geo_accession").alias("accession"))


def fenced_outputs(spark, sf):
    f = _t(spark, sf, "fact_records").filter(F.col("raw_output").startswith("```"))
    return f.select("fact_id", X.without_fence(F.col("raw_output")).alias("body"))


def parse_rates(spark, sf):
    f = _t(spark, sf, "fact_records")
    return f.groupBy("worker_id").agg(
        F.count("*").alias("n"), F.count_if("valid_schema").alias("n_valid"), F.count(F.when(F.try_parse_json("raw_output").isNotNull(), 1)).alias("n_strict"), F.count(X.tolerant_json(F.col("raw_output"))).alias("n_tolerant")
    )


def token_tiers(spark, sf):
    d = _t(spark, sf, "documents")
    # the wide logs of a source are one record each, so tiers beyond S occur too
    b = F.octet_length(F.coalesce("text", F.lit(""))) * 8
    levels = spark.createDataFrame([(x,) for x in ("S", "M", "L", "XL")], "tier string")
    got = d.select(X.size_tier(b).alias("tier"), X.token_estimate(F.col("text")).alias("tokens")).groupBy("tier").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"))
    return F.broadcast(levels).join(got, "tier", "left").select("tier", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("tokens", F.lit(0)).alias("tokens"), X.tier_tokens(F.col("tier")).alias("max_tokens"))


def prompts(spark, sf):
    s = _t(spark, sf, "samples").select("geo_accession", "series_id", "sample_string").distinct()
    user = X.fact_prompt(F.col("geo_accession"), F.col("series_id"), F.col("sample_string"))
    m = X.messages(F.lit("Return one JSON fact."), user)
    system = F.array_join(F.transform(F.filter(m, lambda x: x["role"] == "system"), lambda x: x["content"]), "\n\n")
    return s.select("geo_accession", F.md5(user).alias("user_md5"), F.length(user).alias("n_chars"), system.alias("system"), F.size(m).alias("n_messages"))


def job_scripts(spark, sf):
    s = _t(spark, sf, "studies")
    t = F.lit("run __NAME__ on __SERIES__ for __TIME__")
    return s.select("series_id", X.render(t, {"NAME": X.slug(F.col("study_title")), "SERIES": F.col("series_id"), "TIME": X.clock_text(F.length("study_summary") * 7)}).alias("script"))


def method_tags(spark, sf):
    s = _t(spark, sf, "studies")
    tagged = F.concat(F.coalesce("study_title", F.lit("")), F.when(F.pmod(F.length("series_id") + F.length("study_summary"), F.lit(3)) == 0, " [bulk]").otherwise(""))
    return s.select("series_id", F.coalesce(tagged.rlike(X.METHOD_TAG), F.lit(False)).alias("has_tag"))


def iso_stamps(spark, sf):
    s = _t(spark, sf, "studies")
    t = F.col("submitted_at")
    return s.select("series_id", F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"), F.date_format(t, "yyyyMMdd'T'HHmmss'Z'").alias("stamp"), F.datediff(F.lit("2026-01-01").cast("date"), t).alias("days_old"))


def clock_times(spark, sf):
    s = _t(spark, sf, "studies").select("series_id", F.length("study_summary").alias("n"))
    text = F.concat(F.lit("1-"), X.clock_text(F.col("n") * 5))
    return s.select("series_id", text.alias("clock"), X.clock_seconds(text).alias("seconds"), F.floor(X.clock_seconds(text) / 60).alias("minutes"))


_KIND = r"""case
    when regexp_matches(t, '(?i)(?:factorial)|(?:\+\w+\s+\+\w+)|(?:\+\w+\s+-\w+)') then 'factorial'
    when regexp_matches(t, '(?i)(?:conditioned\s+media)|(?:transwell)|(?:co-?culture)|(?:paracrine)|(?:bystander\s+effect)') then 'mediated_effect'
    when regexp_matches(t, '(?i)(?:irradiat)|(?:untreated.*treated)|(?:sham.*irradiat)') or regexp_matches(t, '(?:(\d+\s*[Gg]y\b.*){2,})|(?:(0\s*[Gg]y).*(\d+\s*[Gg]y))') then 'treatment_vs_untreated'
    when regexp_matches(t, '(?i)(?:(\d+\s*[hd]\b.*){2,})|(?:time\s*course)|(?:kinetic)') then 'time_course'
    when regexp_matches(t, '(?i)(?:\bsiRNA\b)|(?:\bshRNA\b)|(?:knockdown)|(?:knock-?down)|(?:inducible.*[Dd]ox)|(?:[Dd]ox.*induc)|(?:tetracycline.*induc)') or regexp_matches(t, '(?:\bsi-?[A-Z][A-Z0-9]+\b)|(?:\bsh-?[A-Z][A-Z0-9]+\b)|(?:[+-]\s*[Dd]ox\b)') then 'knockdown_panel'
    when regexp_matches(t, '(?i)(?:\bknockout\b)|(?:wild-?type)') or regexp_matches(t, '(?:\bKO\b)|(?:-/-)|(?:\+/\+)|(?:\bWT\b)') then 'knockout_vs_wt'
    when regexp_matches(t, '(?i)(?:\bdisease\b)|(?:\bcancer\b)|(?:\btumor\b)|(?:\btumour\b)|(?:patient)|(?:carcinoma)|(?:glioblastoma)|(?:leukemia)|(?:lymphoma)|(?:(healthy|normal).*(control|tissue|cortex|donor))') then 'disease_vs_normal'
    when regexp_matches(t, '(?i)(?:\bDMSO\b)|(?:\bvehicle\b)|(?:\bdrug\b)|(?:compound)') or regexp_matches(t, '(?:\b\d+\s*[uM]M\b)|(?:\b\d+\s*nM\b)') then 'treatment_vs_vehicle'
    else 'unknown' end"""
_NZ = "coalesce({0} <> '', false)"
_SLUG = "nullif(regexp_replace(substr(regexp_replace(regexp_replace(lower(study_title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 24), '-+$', ''), '')"
_CLOCK = "printf('%02d:%02d:%02d', {0} // 3600, ({0} // 60) % 60, {0} % 60)"

QUERIES = {f.__name__: f for f in (
    composed_text, reject_counts, keyword_label, keyword_kind, keyword_kind_documents, dose_duration_keys, cell_and_kind_keys, kind_names, hash_keys, slugs, first_of_list,
    failure_modes, fenced_outputs, parse_rates, token_tiers, prompts, job_scripts, method_tags, iso_stamps, clock_times,
)}

ORACLE_SQL = {
    "composed_text": """select series_id, concat_ws(',', case when coalesce(study_title <> '', false) then 'title: ' || study_title end,
        case when coalesce(srp <> '', false) then 'source: ' || srp end, case when coalesce(overall_design <> '', false) then overall_design end) as text from studies""",
    "reject_counts": """select case when lang is null or source is null then 'unknown' when lang <> 'en' then 'not_human' when source <> 'study_summary' then 'not_bulk_rnaseq'
        when coalesce(length(text) < 600, true) then 'string_too_short' else 'kept' end as reason, count(*) as n from documents group by 1""",
    "keyword_label": f"""select case lower(trim(trtctr_ep)) when 'treated' then 'treated' when 'control' then 'control' end as gold,
        case when regexp_matches(lower(coalesce(trtctr, '')), '\\b(ctrl|control|wildtype|wild-type|wild type|wt|dmso|vehicle|untreated|mock|uninfected|naive|non-targeting|scrambled|sint|sineg|shnt|empty vector|ev|parental)\\b') then 'control' else 'treated' end as predicted, count(*) as n from samples group by 1, 2""",
    "keyword_kind": f"select geo_accession, strftime(loaded_at, '%Y-%m-%d %H:%M:%S') as loaded, {_KIND} as kind from (select geo_accession, loaded_at, concat_ws(' ', sample_string, trtctr) as t from samples)",
    "keyword_kind_documents": f"select source, {_KIND} as kind, count(*) as n from (select source, translate(text, chr(10) || chr(13), '  ') as t from documents) group by 1, 2",
    "dose_duration_keys": """with p as (select perturbation_id, dose.value_raw as d, duration.value_raw as r, lower(regexp_replace(duration.value_raw, '\\s+', '', 'g')) as t from perturbations),
        q as (select *, try_cast(regexp_extract(t, '^([0-9.]+)([a-z]+)$', 1) as double) as x, regexp_extract(t, '^([0-9.]+)([a-z]+)$', 2) as u from p)
        select perturbation_id, case when coalesce(d <> '', false) then replace(regexp_replace(d, '\\s+', '', 'g'), chr(181), 'u') else 'nodose' end as dose_key,
        case when coalesce(r = '', true) then 'na' when x is null then t when u in ('min', 'mins', 'minute', 'minutes') then printf('%.7g', x / 60) || 'h' when u in ('h', 'hr', 'hrs', 'hour', 'hours') then printf('%.7g', x) || 'h'
        when u in ('d', 'day', 'days') and x < 6 then printf('%.7g', x * 24) || 'h' when u in ('d', 'day', 'days') then printf('%.7g', x) || 'd' else t end as duration_key from q""",
    "cell_and_kind_keys": "select context_id, coalesce(nullif(cell_line_cellosaurus_candidate, ''), nullif(cell_type_or_line_raw, ''), 'unclear') as cell_key from cell_contexts",
    "kind_names": """select case pert_kind when 'cytokine_stimulation' then 'cytokine_stim' when 'environmental_or_behavioral' then 'environmental' when 'mechanical_or_physical' then 'mechanical' else pert_kind end as kind,
        count(*) as n from perturbations group by 1""",
    "hash_keys": """select geo_accession, 'v3:' || sha256(sample_string) as cache_key, greatest(1, ('0x' || substr(md5(series_id || ':42'), 1, 7))::bigint) as seed
        from (select distinct geo_accession, series_id, sample_string from samples where sample_string is not null)""",
    "slugs": f"""select series_id, s as slug, concat_ws('-', '20260101T000000Z', s, substr(md5(series_id), 1, 6)) as run_id,
        case when s is null then concat_ws('-', '20260101T000000Z', substr(md5(series_id), 1, 6)) else s end as short_id, series_id as base_id from (select series_id, {_SLUG} as s from studies)""",
    "first_of_list": """select trim(string_split(series_id, ',')[1]) as canonical, count(*) as n, sum(len(list_filter(list_transform(string_split(series_id, ','), lambda x: trim(x)), lambda x: x <> '')))::bigint as n_ids
        from samples group by 1""",
    "failure_modes": """select fact_id, case when coalesce(length(tail) - length(replace(tail, chr(9), '')) >= 20, false) then 'A' when coalesce(length(raw_output) >= 2400 and not regexp_matches(raw_output, '[\\s.]{30}'), false) then 'B' else 'other' end as mode,
        nullif(regexp_extract(raw_output, '"geo_accession"\\s*:\\s*"([^"]+)"', 1), '') as accession from (select *, substr(raw_output, greatest(1, length(raw_output) - 50), 51) as tail from fact_records)""",
    "fenced_outputs": """select fact_id, regexp_replace(regexp_replace(raw_output, '^\\s*```[ ]*[A-Za-z]*\\s*', ''), '\\s*```\\s*$', '') as body from fact_records where starts_with(raw_output, '```')""",
    "parse_rates": """select worker_id, count(*) as n, count(*) filter (valid_schema) as n_valid, count(*) filter (raw_output <> '' and json_valid(raw_output)) as n_strict,
        count(*) filter ((trim(raw_output) <> '' and json_valid(trim(raw_output))) or (regexp_extract(trim(raw_output), '(?s)\\{.*\\}') <> '' and json_valid(regexp_extract(trim(raw_output), '(?s)\\{.*\\}')))) as n_tolerant
        from fact_records group by 1""",
    "token_tiers": """with d as (select case when b < 15360 then 'S' when b < 25600 then 'M' when b < 35840 then 'L' else 'XL' end as tier, greatest(1, ceil(strlen(coalesce(text, '')) / 4))::bigint as tokens
        from (select text, strlen(coalesce(text, '')) * 8 as b from documents))
        select l.tier, count(d.tier) as n, coalesce(sum(tokens), 0)::bigint as tokens, any_value(m)::int as max_tokens from (values ('S', 4096), ('M', 8192), ('L', 16384), ('XL', 32768)) l(tier, m) left join d using (tier) group by 1""",
    "prompts": """select geo_accession, md5(u) as user_md5, length(u)::int as n_chars, 'Return one JSON fact.' as system, 2 as n_messages from (select geo_accession,
        concat_ws(chr(10), 'sample: ' || geo_accession, 'study: ' || series_id, 'text: ' || sample_string) as u from (select distinct geo_accession, series_id, sample_string from samples))""",
    "job_scripts": f"""select series_id, 'run ' || s || ' on ' || series_id || ' for ' || {_CLOCK.format("n")} as script from (select series_id, {_SLUG} as s, length(study_summary) * 7 as n from studies)""",
    "method_tags": f"""select series_id, coalesce(regexp_matches(coalesce(study_title, '') || case when (length(series_id) + length(study_summary)) % 3 = 0 then ' [bulk]' else '' end, '(?i)\\[(scRNA|RNA-Seq|RNA-seq|single-cell|bulk|ATAC|ChIP)|\\((scRNA|RNA-seq|bulk|ATAC|ChIP)'), false) as has_tag from studies""",
    "iso_stamps": """select series_id, strftime(submitted_at, '%Y-%m-%dT%H:%M:%SZ') as iso, strftime(submitted_at, '%Y%m%dT%H%M%SZ') as stamp, datediff('day', submitted_at::date, date '2026-01-01')::int as days_old from studies""",
    "clock_times": f"""select series_id, '1-' || {_CLOCK.format("n")} as clock, (86400 + n)::bigint as seconds, ((86400 + n) // 60)::bigint as minutes from (select series_id, length(study_summary) * 5 as n from studies)""",
}
