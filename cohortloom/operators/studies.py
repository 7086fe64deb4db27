"""Studies: canonical study of a sample, groups and roles, comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_list


def accession_number(c: Column) -> Column:
    return F.regexp_replace(c, "^[A-Z]+", "").cast("double")


def resolve_series(samples: DataFrame, series: str, studies: DataFrame) -> DataFrame:
    """Adds ``resolved`` and ``branch`` for a comma list of studies.

    ``studies`` has series_id, is_super, has_srp; unknown studies count as neither. Each distinct list is
    resolved once and joined back. Null or blank lists give null and ``no_series``.
    """
    lists = samples.select(F.col(series).alias("_list")).filter(F.col("_list").isNotNull()).distinct()
    parts = lists.select("_list", F.posexplode(split_list(F.col("_list"))).alias("pos", "gse"))
    known = studies.groupBy("series_id").agg(F.bool_or("is_super").alias("is_super"), F.bool_or("has_srp").alias("has_srp"))
    rows = parts.join(known, parts.gse == known.series_id, "left").select("_list", "pos", "gse", F.coalesce("is_super", F.lit(False)).alias("is_super"), F.coalesce("has_srp", F.lit(False)).alias("has_srp"))
    item = F.struct("pos", "gse", "is_super", "has_srp", accession_number(F.col("gse")).alias("num"))
    got = rows.groupBy("_list").agg(F.sort_array(F.collect_list(item)).alias("all"))
    got = got.withColumn("open", F.filter("all", lambda x: ~x["is_super"])).withColumn("srp", F.filter("open", lambda x: x["has_srp"]))
    smallest = F.array_min(F.transform("open", lambda x: F.struct(x["num"].alias("num"), x["gse"].alias("gse"))))["gse"]
    first = F.get("all", F.lit(0))["gse"]
    n, k, s = F.size("all"), F.size("open"), F.size("srp")
    a_srp = F.get("open", F.lit(0))["has_srp"]
    # fixed values: the names of the branches
    branch = (
        F.when(n == 1, "single_gse").when(k == 1, "clean_super_scarted").when(k == 0, "all_super_pathological")
        .when((k == 2) & (s == 2), "tiebreak_both_srp").when((k == 2) & (s == 0), "fallback_no_srp")
        .when((k == 2) & a_srp, "srp_a_only").when(k == 2, "srp_b_only")
        .when(s == 1, "srp_one_of_many").otherwise("multi_gse_multi_branch")
    )
    resolved = F.when(n == 1, first).when(k == 1, F.get("open", F.lit(0))["gse"]).when(k == 0, first).when((s == 1), F.get("srp", F.lit(0))["gse"]).otherwise(smallest)
    table = got.select("_list", resolved.alias("resolved"), branch.alias("branch"))
    out = samples.join(table, samples[series] == table["_list"], "left").drop("_list")
    return out.withColumn("branch", F.coalesce("branch", F.lit("no_series")))


def pair_decision(df: DataFrame, a: str, b: str, srp_a: Column, srp_b: Column) -> DataFrame:
    """Branch, decision, tiebreak and agreement with the smaller-accession rule, for pairs of studies."""
    low = F.when(accession_number(F.col(a)) < accession_number(F.col(b)), F.col(a)).otherwise(F.col(b))
    branch = F.when(srp_a & ~srp_b, "srp_a_only").when(~srp_a & srp_b, "srp_b_only").when(srp_a & srp_b, "both_srp").otherwise("no_srp")
    decision = F.when(F.col("branch") == "srp_a_only", F.col(a)).when(F.col("branch") == "srp_b_only", F.col(b)).otherwise(low)
    return df.withColumn("branch", branch).withColumn("decision", decision).withColumn("tiebreak_used", F.col("branch").isin("both_srp", "no_srp")).withColumn("rule_agrees", F.col("decision") == low)


def case_type(a_super: Column, b_super: Column) -> Column:
    """all_super, clean, ambiguous, or other where a side is unknown."""
    return F.when(a_super.isNull() | b_super.isNull(), "other").when(a_super & b_super, "all_super").when(a_super | b_super, "clean").otherwise("ambiguous")


def sample_roles(designs: DataFrame, keep: str = "last") -> DataFrame:
    """(series_id, sample, role): one role per sample; the last or the first group wins.

    ``designs`` has series_id and groups, an array of {group_id, role, sample_ids}.
    """
    flat = designs.select("series_id", F.posexplode("groups").alias("gpos", "g")).select("series_id", "gpos", F.col("g.role").alias("role"), F.posexplode("g.sample_ids").alias("spos", "sample"))
    place = F.struct("gpos", "spos")
    chosen = F.max_by("role", place) if keep == "last" else F.min_by("role", place)
    return flat.groupBy("series_id", "sample").agg(chosen.alias("role"))


def comparisons(designs: DataFrame, facts: DataFrame) -> DataFrame:
    """One row per comparison with its representative fact.

    ``designs``: series_id, groups (group_id, role, sample_ids), pairs (comparison_id, treated, control).
    A comparison whose treated group is missing or empty, or whose first treated sample has no fact, gives no
    row; a missing control group counts 0 samples; of equal group ids the last counts.
    """
    group = designs.select("series_id", F.posexplode("groups").alias("gpos", "g")).groupBy("series_id", F.col("g.group_id").alias("group_id")).agg(F.max_by("g", "gpos").alias("g"))
    pair = designs.select("series_id", F.explode("pairs").alias("p")).select("series_id", "p.*")
    treated = group.select("series_id", F.col("group_id").alias("treated"), F.col("g.role").alias("treated_role"), F.col("g.sample_ids").alias("treated_ids"))
    control = group.select("series_id", F.col("group_id").alias("control"), F.size("g.sample_ids").alias("n_samples_control"))
    out = pair.join(treated, ["series_id", "treated"]).filter(F.size("treated_ids") > 0).join(control, ["series_id", "control"], "left")
    out = out.withColumn("representative", F.get("treated_ids", F.lit(0)))
    out = out.join(facts.withColumnRenamed("sample", "representative"), "representative")
    return out.withColumn("n_samples_treated", F.size("treated_ids")).withColumn("n_samples_control", F.coalesce("n_samples_control", F.lit(0))).drop("treated_ids")


def ordinal_labels(groups: DataFrame) -> DataFrame:
    """(series_id, sample, label): groups in numeric order of their key, the last is control, the others treated; the first label of a sample counts.

    ``groups`` has series_id, group_key, sample_ids.
    """
    last = groups.groupBy("series_id").agg(F.max(F.struct(F.col("group_key").cast("int").alias("k"), "group_key")).alias("m")).select("series_id", F.col("m.k").alias("last_key"))
    rows = groups.join(last, "series_id").select("series_id", F.col("group_key").cast("int").alias("k"), "last_key", F.posexplode("sample_ids").alias("pos", "sample"))
    label = F.when(F.col("k") == F.col("last_key"), "control").otherwise("treated")
    return rows.groupBy("series_id", "sample").agg(F.min_by(label, F.struct("k", "pos")).alias("label"))
