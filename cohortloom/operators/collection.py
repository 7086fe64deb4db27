"""Collecting the output of batch runs: forced fields, records for failures, partition, merged status, checked unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import design_schema, fact_schema
from .runs import TERMINAL

# --- fixed values: versions and the record that stands for a failure --------------------------------------
FACT_VERSION = "stage1.v3"
DESIGN_VERSION = "stage2.v2"
SKELETON = """{"organism": null, "host_organism": null,
  "cell_context": {"context_kind": "unclear", "engineered_modifications": [], "co_culture_partners": [], "sort_markers": [], "cell_composition_estimates": []},
  "disease_state": {"status": "none"}, "perturbations": [], "technical_treatments": [], "patient_metadata": null,
  "extraction": {"confidence": 0, "ambiguity_flags": ["metadata_inconsistency"]}}"""
PROMOTED_FROM, PROMOTED_LENGTH = 16384, 65536
# ---------------------------------------------------------------------------------------------------------


def parsed_object(raw: Column, schema: object) -> Column:
    """The struct of a text that is one JSON object, read strictly; anything else is null."""
    return F.when(F.try_parse_json(raw).isNotNull() & F.ltrim(raw).startswith("{"), F.from_json(raw, schema))


def input_hash(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.coalesce(text, F.lit("")), 256))


def forced_fact(fact: Column, accession: Column, series: Column, text: Column, model: str) -> Column:
    """``fact`` with ids, version, model and input hash written over whatever the model answered; a fact without ``extraction`` stays as it is."""
    out = fact.withField("geo_accession", accession).withField("series_id", series)
    out = out.withField("extraction.schema_version", F.lit(FACT_VERSION)).withField("extraction.model", F.lit(model)).withField("extraction.raw_input_hash", input_hash(text))
    return F.when(fact["extraction"].isNull(), fact).otherwise(out)


def forced_design(design: Column, series: Column, n_samples: Column, model: str) -> Column:
    """``design`` with the study's own id and counts; a missing ``extraction`` is made, and a missing ``input_truncated`` is false."""
    empty = F.from_json(F.lit("{}"), design_schema()["extraction"].dataType)
    e = F.coalesce(design["extraction"], empty)
    e = e.withField("schema_version", F.lit(DESIGN_VERSION)).withField("model", F.lit(model)).withField("input_sample_count", n_samples.cast("int"))
    return design.withField("series_id", series).withField("extraction", e.withField("input_truncated", F.coalesce(e["input_truncated"], F.lit(False))))


def failure_record(accession: Column, series: Column, text: Column, model: str) -> Column:
    """A record of the fact's shape that stands for a failed one: confidence 0 and a flag."""
    return forced_fact(F.from_json(F.lit(SKELETON), fact_schema()), accession, series, text, model)


def collect_predictions(rows: DataFrame, inputs: DataFrame, raw: str, valid: str, model: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(predictions, errors, summary) of ``rows(record_id, ...)``, whose parsed facts are enriched from ``inputs(record_id, accession, series, text)``.

    A row whose id has no input keeps its parsed fact; a null validity is an error; summary has one row with the counts.
    """
    parsed = rows.withColumn("parsed", parsed_object(F.col(raw), fact_schema())).join(inputs.withColumn("_known", F.lit(True)), "record_id", "left")
    fact = F.when(F.col("_known"), forced_fact(F.col("parsed"), F.col("accession"), F.col("series"), F.col("text"), model)).otherwise(F.col("parsed"))
    done = parsed.withColumn("fact", fact).drop("parsed", "accession", "series", "text", "_known")
    ok = F.coalesce(F.col(valid), F.lit(False))
    summary = done.agg(F.count("*").alias("n_rows"), F.count_if(ok).alias("n_valid"), F.count_if(~ok).alias("n_errors"), F.count("fact").alias("n_parsed"))
    return done.filter(ok), done.filter(~ok), summary


def next_state(current: Column, candidate: Column) -> Column:
    """The candidate, unless the run has ended and the candidate hasn't, or collected would go back to completed."""
    back = (current.isin(*TERMINAL) & ~candidate.isin(*TERMINAL)) | ((current == "collected") & (candidate == "completed"))
    return F.when(candidate.isNull() | F.coalesce(back, F.lit(False)), current).otherwise(candidate)


def merged_status(stored: DataFrame, remote: DataFrame, scheduler: DataFrame, key: str, now: Column) -> DataFrame:
    """Status of each stored run: what the run itself reports, else the scheduler, else what is stored.

    ``stored``: key, state, source, running_at, completed_at, failed_at, n_total, n_done, n_failed; ``remote``: key, state,
    started_at, finished_at, n_total, n_done, n_failed; ``scheduler``: key, state. One row a key in each. A state's time is
    kept once it is set, else reported, else ``now``.
    """
    r = remote.select(key, *[F.col(c).alias(f"r_{c}") for c in remote.columns if c != key])
    s = scheduler.select(key, F.col("state").alias("s_state"))
    x = stored.join(r, key, "left").join(s, key, "left")
    state = next_state(F.coalesce("state", F.lit("created")), F.coalesce("r_state", "s_state", "state", F.lit("created")))
    x = x.withColumn("next", state)
    at = lambda name, reported, when: F.coalesce(reported, F.col(name), F.when(F.col("next") == when, now))
    source = F.when(F.col("r_state").isNotNull(), "remote").when(F.col("s_state").isNotNull(), "scheduler").otherwise(F.col("source"))
    return x.select(
        key, F.coalesce("state", F.lit("created")).alias("previous"), F.col("next").alias("state"), source.alias("source"), (F.coalesce("state", F.lit("created")) != F.col("next")).alias("changed"),
        at("running_at", F.col("r_started_at"), "running").alias("running_at"),
        F.when(F.col("next") == "completed", at("completed_at", F.col("r_finished_at"), "completed")).otherwise(F.col("completed_at")).alias("completed_at"),
        at("failed_at", F.lit(None), "failed").alias("failed_at"),
        F.coalesce("r_n_total", "n_total").alias("n_total"), F.coalesce("r_n_done", "n_done", F.lit(0)).alias("n_done"), F.coalesce("r_n_failed", "n_failed", F.lit(0)).alias("n_failed"),
    )


def union_exact(parts: list[DataFrame], expected: int) -> DataFrame:
    """The parts one behind the other; an error if they don't have exactly ``expected`` rows together."""
    out = reduce(lambda a, b: a.unionByName(b), parts)
    n = out.count()
    if n != expected:
        raise ValueError(f"{n} rows, not {expected}")
    return out


def require_disjoint(a: DataFrame, b: DataFrame, key: str) -> None:
    """An error that names a key which both tables have."""
    both = a.select(key).join(b.select(key), key, "left_semi").first()
    if both is not None:
        raise ValueError(f"{key} {both[0]} is in both tables")


def replace_exactly_one(df: DataFrame, key: str, row: DataFrame) -> DataFrame:
    """``df`` with the one row whose key ``row`` has replaced; an error unless exactly one is."""
    hits = df.join(F.broadcast(row.select(key)), key, "left_semi").count()
    if row.count() != 1 or hits != 1:
        raise ValueError(f"{hits} rows to replace, not 1")
    return df.join(F.broadcast(row.select(key)), key, "left_anti").unionByName(row)


def settled_groups(parts: DataFrame, group: str, ok: Column) -> tuple[DataFrame, DataFrame]:
    """(moved, kept): rows of the groups all of whose rows succeeded, and of the others."""
    whole = parts.groupBy(group).agg(F.bool_and(F.coalesce(ok, F.lit(False))).alias("_whole"))
    marked = parts.join(whole, group)
    return marked.filter("_whole").drop("_whole"), marked.filter("not _whole").drop("_whole")


def promoted_limits(tiers: DataFrame, tier: str, tokens: str, base_tokens: int, base_length: int) -> DataFrame:
    """One row: the token limit and model length that all tiers present need."""
    most = F.greatest(F.lit(base_tokens), F.coalesce(F.max(tokens), F.lit(0)))
    return tiers.agg(most.alias("max_tokens"), F.when(F.max(tokens) >= PROMOTED_FROM, F.greatest(F.lit(base_length), F.lit(PROMOTED_LENGTH))).otherwise(F.lit(base_length)).alias("max_model_len"), F.count_distinct(tier).alias("n_tiers"))


def with_attribute(record: Column, name: str, value: Column) -> Column:
    """A JSON object text with one more attribute at its end; null and texts that are no object stay as they are."""
    t = F.trim(record)
    head = F.rtrim(F.substring(t, F.lit(1), F.length(t) - 1))
    joint = F.when(F.rtrim(head) == "{", F.lit("")).otherwise(F.lit(","))
    return F.when(t.startswith("{") & t.endswith("}"), F.concat(head, joint, F.lit(f'"{name}":'), value.cast("string"), F.lit("}"))).otherwise(record)


def missing_predictions(wanted: DataFrame, outputs: DataFrame, group: str, record: str, valid: Column) -> DataFrame:
    """Per group with unanswered records: how many, how many of its outputs are predictions, and whether it has errors."""
    ok = F.coalesce(valid, F.lit(False))
    answered = outputs.filter(ok).select(record).distinct()
    open_rows = wanted.join(answered, record, "left_anti").groupBy(group).agg(F.count("*").alias("n_missing"))
    seen = outputs.groupBy(group).agg(F.count_if(ok).alias("n_predictions"), F.bool_or(~ok).alias("in_errors"))
    return open_rows.join(seen, group, "left").select(group, "n_missing", F.coalesce("n_predictions", F.lit(0)).alias("n_predictions"), F.coalesce("in_errors", F.lit(False)).alias("in_errors"))


def index_sizes(nodes: DataFrame, ids: str, groups: str) -> DataFrame:
    """(series, n_signatures): a node's comma list of series, each with the number of samples in the node's map of groups; the first node of a series counts.

    ``nodes`` has ``node`` (the order), the list and MAP<STRING, ARRAY<STRING>>; blank series are left out.
    """
    n = F.aggregate(F.map_values(groups), F.lit(0), lambda s, a: s + F.coalesce(F.size(a), F.lit(0)))
    flat = nodes.select("node", F.posexplode(F.transform(F.split(ids, ","), lambda x: F.trim(x))).alias("pos", "series"), F.coalesce(n, F.lit(0)).alias("n_signatures")).filter("series <> ''")
    return flat.groupBy("series").agg(F.min_by("n_signatures", F.struct("node", "pos")).alias("n_signatures"))
