"""Queries that evaluate labels against references: metrics, intervals, tests, agreement, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import evaluation as V


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _r(c, digits: int = 6):
    return F.round(c, digits)


def _labels(spark, sf):
    """geo_accession, gold and predicted binary labels, keyword kind."""
    s = _t(spark, sf, "samples")
    return s.select("geo_accession", "series_id", X.label_binary(F.col("gold")).alias("gold"), X.control_label(F.col("treat")).alias("predicted"), X.design_kind(F.concat_ws(" ", "sample_string", "treat")).alias("kind"))


_METRICS = ["accuracy", "sensitivity", "specificity", "f1"]


def binary_metrics(spark, sf):
    m = V.binary_metrics(_labels(spark, sf), "gold", "predicted")
    low, high = V.wilson(F.col("tp") + F.col("tn"), F.col("n"))
    return m.select("tp", "tn", "fp", "fn", "n", *[_r(c).alias(c) for c in _METRICS], _r(low).alias("low"), _r(high).alias("high"))


def metrics_by_kind(spark, sf):
    m = V.binary_metrics(_labels(spark, sf), "gold", "predicted", "kind")
    low, high = V.wilson(F.col("tp") + F.col("tn"), F.col("n"))
    return m.select("kind", "tp", "tn", "fp", "fn", "n", *[_r(c).alias(c) for c in _METRICS], _r(low).alias("low"), _r(high).alias("high"))


def metrics_long(spark, sf):
    m = V.binary_metrics(_labels(spark, sf), "gold", "predicted").select(*[_r(c).alias(c) for c in _METRICS])
    return m.unpivot([], _METRICS, "metric", "value")


def confusion_table(spark, sf):
    return V.confusion(_labels(spark, sf).dropna(subset=["gold"]), "gold", "predicted", ["control", "treated"])


def contingency(spark, sf):
    return _t(spark, sf, "samples").groupBy("trtctr_ep", F.coalesce("gold", F.lit("(null)")).alias("gold")).agg(F.count("*").alias("n"))


def low_accuracy_groups(spark, sf):
    m = V.binary_metrics(_labels(spark, sf), "gold", "predicted", "series_id")
    return m.filter(F.col("accuracy") < 0.75).select("series_id", "n", _r("accuracy").alias("accuracy"), F.when(F.col("n") >= 25, "tested").otherwise("too_few").alias("guard"))


def key_field_recall(spark, sf):
    p, c = _t(spark, sf, "perturbations"), _t(spark, sf, "cell_contexts")
    kinds = p.agg(F.count("*").alias("n_perturbations"), _r(F.avg((~F.col("pert_kind").isin("none", "unclear", "vehicle_only")).cast("double"))).alias("kind_recall"))
    cells = c.agg(F.count("*").alias("n_contexts"), _r(F.avg(X.filled(F.col("cell_type_or_line_raw")).cast("double"))).alias("cell_recall"))
    return kinds.crossJoin(F.broadcast(cells))


def validity_by_worker(spark, sf):
    f = _t(spark, sf, "fact_records").groupBy("worker_id").agg(F.count("*").alias("n"), F.count_if("valid_schema").alias("n_valid"))
    low, high = V.wilson(F.col("n_valid"), F.col("n"))
    return f.select("worker_id", "n", "n_valid", _r(F.try_divide("n_valid", "n")).alias("rate"), _r(low).alias("low"), _r(high).alias("high"))


def _votes(spark, sf):
    """case_id, annotator, choice A, B, both, unclear or null."""
    v = _t(spark, sf, "resolver_votes")
    x = F.trim(F.regexp_replace(F.lower("choice"), "[^a-z]+", " "))
    x = F.regexp_replace(x, "^series ", "")
    label = F.when(x == "a", "A").when(x == "b", "B").when(x.isin("both", "unclear"), x)
    return v.select("vote_id", "case_id", "annotator", "voted_at", label.alias("label"))


def majority_labels(spark, sf):
    return V.majority(_votes(spark, sf), ["case_id"], "label")


def disputed_cases(spark, sf):
    return _votes(spark, sf).groupBy("case_id").agg(F.count_distinct("label").alias("n_labels"), F.count("label").alias("n_votes")).filter("n_labels >= 3")


def _judged(spark, sf):
    """Cases with the correctness of both models against the majority."""
    c = _t(spark, sf, "resolver_cases").join(V.majority(_votes(spark, sf), ["case_id"], "label"), "case_id")
    ok = lambda x: F.when(F.col(x).isin("A", "B", "both", "unclear"), F.col(x) == F.col("majority"))
    return c.select("case_id", "primary_gse", "srp_match", "majority", "claude_choice", "gpt_choice", ok("claude_choice").alias("right_a"), ok("gpt_choice").alias("right_b"))


def paired_test(spark, sf):
    m = V.mcnemar(_judged(spark, sf), "right_a", "right_b", "srp_match")
    return m.select("srp_match", "b", "c", _r("chi_square").alias("chi_square"))


def paired_test_p(spark, sf):
    return V.mcnemar(_judged(spark, sf), "right_a", "right_b", continuity=True)


def bootstrap_interval(spark, sf):
    return V.bootstrap_delta(_judged(spark, sf), "right_a", "right_b")


def head_to_head(spark, sf):
    j = _judged(spark, sf).groupBy("srp_match").agg(F.avg(F.col("right_a").cast("double")).alias("a"), F.avg(F.col("right_b").cast("double")).alias("b"), F.count("*").alias("n"))
    return j.select("srp_match", "n", _r("a").alias("accuracy_a"), _r("b").alias("accuracy_b"), _r(F.col("b") - F.col("a")).alias("delta"))


def top_confusions(spark, sf):
    j = _judged(spark, sf)
    long = j.select("majority", F.explode(F.array(F.struct(F.lit("claude").alias("model"), F.col("claude_choice").alias("choice")), F.struct(F.lit("gpt").alias("model"), F.col("gpt_choice").alias("choice")))).alias("m"))
    n = long.select("majority", "m.*").filter("choice is not null and choice <> majority").groupBy("model", "majority", "choice").agg(F.count("*").alias("n"))
    # the counts are a small table already: five per model by an ordered array
    best = n.groupBy("model").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "majority", "choice"))), 1, 5).alias("top"))
    return best.select("model", F.posexplode("top").alias("rank", "x")).select("model", "rank", F.col("x.majority").alias("majority"), F.col("x.choice").alias("choice"), (-F.col("x.o")).alias("n"))


def grouping_sets(spark, sf):
    j = _judged(spark, sf)
    tier = F.when(F.col("srp_match"), "easy").otherwise("hard")
    long = j.select(tier.alias("tier"), F.explode(F.array(F.struct(F.lit("claude").alias("model"), "right_a"), F.struct(F.lit("gpt").alias("model"), F.col("right_b").alias("right_a")))).alias("m")).select("tier", "m.*")
    # a missing prediction counts as wrong here
    out = long.withColumn("right_a", F.coalesce("right_a", F.lit(False)).cast("double")).groupingSets([[F.col("model")], [F.col("model"), F.col("tier")]], F.col("model"), F.col("tier")).agg(
        F.count("*").alias("n"), F.avg("right_a").alias("accuracy"), F.grouping("tier").alias("_g")
    )
    return out.select("model", F.when(F.col("_g") == 1, "overall").otherwise(F.col("tier")).alias("tier"), "n", _r("accuracy").alias("accuracy"))


def adjusted_p_values(spark, sf):
    s = _t(spark, sf, "samples").groupBy(F.substring("series_id", -1, 1).alias("g")).agg(F.avg((X.label_binary(F.col("trtctr_ep")) == "treated").cast("double")).alias("p"))
    return V.holm(s.withColumn("p", _r(F.col("p") / 20)), "p", order=["g"]).select("g", "p", _r("p_holm").alias("p_holm"))


def model_agreement(spark, sf):
    """Pairwise agreement of three labellers per study, their score and difficulty tier."""
    c = _t(spark, sf, "resolver_cases").select("case_id", "primary_gse", "claude_choice", "gpt_choice")
    good = lambda x: F.when(F.col(x).isin("A", "B", "both", "unclear"), F.col(x))
    m = V.majority(_votes(spark, sf), ["case_id"], "label").select("case_id", F.col("majority").alias("label"), F.lit("people").alias("model"))
    long = c.select("case_id", good("claude_choice").alias("label"), F.lit("claude").alias("model")).unionByName(c.select("case_id", good("gpt_choice").alias("label"), F.lit("gpt").alias("model"))).unionByName(m)
    long = long.join(c.select("case_id", "primary_gse"), "case_id")
    roles = V.pairwise_role_agreement(long, "primary_gse", "case_id", "model", "label")
    sets = long.groupBy("primary_gse", "model").agg(F.collect_set("label").alias("labels"))
    a, b = sets.select("primary_gse", F.col("model").alias("model_a"), F.col("labels").alias("la")), sets.select("primary_gse", F.col("model").alias("model_b"), F.col("labels").alias("lb"))
    pairs = roles.join(a, ["primary_gse", "model_a"]).join(b, ["primary_gse", "model_b"]).withColumn("anchor_match", V.jaccard(F.col("la"), F.col("lb")))
    kind = (F.size("la") == F.size("lb")).cast("double")
    scored = pairs.groupBy("primary_gse").agg(F.count("*").alias("n_pairs"), F.avg(V.confidence_score(kind, F.col("role_match"), F.col("anchor_match"))).alias("score"))
    return scored.select("primary_gse", "n_pairs", _r("score").alias("score"), V.difficulty_tier(_r("score")).alias("tier"))


def quality_gate(spark, sf):
    m = V.binary_metrics(_labels(spark, sf), "gold", "predicted")
    return m.select("n", F.when((F.col("accuracy") >= 0.9) & (F.col("n") >= 100), "PASS").when(F.col("accuracy") >= 0.7, "BORDERLINE").otherwise("FAIL").alias("gate"))


def model_agreement_rate(spark, sf):
    c = _t(spark, sf, "resolver_cases")
    good = ["A", "B", "both", "unclear"]
    agree = F.when(F.col("claude_choice").isin(good) & F.col("gpt_choice").isin(good), (F.col("claude_choice") == F.col("gpt_choice")).cast("double"))
    rate = c.groupBy("srp_match").agg(F.avg(agree).alias("rate"), F.count(agree).alias("n"))
    band = F.when(F.col("rate").isNull(), "not computable").when(F.col("rate") >= 0.85, "high").when(F.col("rate") < 0.5, "low").otherwise("between")
    return rate.select("srp_match", "n", _r("rate").alias("rate"), band.alias("band"))


def size_statistics(spark, sf):
    b = F.octet_length("text")
    d = _t(spark, sf, "documents").groupBy("source").agg(F.min(b).alias("least"), F.percentile(b, F.array(F.lit(0.5), F.lit(0.99))).alias("p"), F.max(b).alias("most"), F.sum(b).alias("total"))
    return d.select("source", F.col("least").cast("long").alias("least"), _r(F.col("p")[0]).alias("median"), _r(F.col("p")[1]).alias("p99"), F.col("most").cast("long").alias("most"), "total")


def kind_counts(spark, sf):
    return _t(spark, sf, "perturbations").groupBy(F.coalesce("phase", F.lit("(null)")).alias("phase"), "pert_kind").agg(F.count("*").alias("n"))


def largest_studies(spark, sf):
    s = _t(spark, sf, "samples").groupBy("series_id").agg(F.count("*").alias("n"))
    return s.orderBy(F.desc("n"), "series_id").limit(20)


def role_sizes(spark, sf):
    s = _t(spark, sf, "samples").groupBy("series_id", X.label_binary(F.col("trtctr_ep")).alias("role")).agg(F.count("*").alias("n"))
    return s.groupBy("role").agg(F.sum("n").alias("n_samples"), F.count("*").alias("n_groups"))


def throughput(spark, sf):
    f = _t(spark, sf, "fact_records").groupBy("worker_id").agg(F.count("*").alias("n"), F.unix_micros(F.max("ts").cast("timestamp_ltz")).alias("t1"), F.unix_micros(F.min("ts").cast("timestamp_ltz")).alias("t0"))
    minutes = (F.col("t1") - F.col("t0")) / 60_000_000.0
    rate = F.try_divide("n", minutes)
    return f.select("worker_id", "n", _r(minutes, 3).alias("minutes"), _r(rate, 4).alias("per_minute"), _r(F.try_divide(F.lit(1_000_000), rate), 1).alias("minutes_for_a_million"))


_GOLD = "case lower(trim({0})) when 'treated' then 'treated' when 'control' then 'control' end"


def _labels_sql() -> str:
    from .text_queries import _KIND

    words = "|".join(X.CONTROL_WORDS)
    return f"""labels as (select geo_accession, series_id, {_GOLD.format('gold')} as gold, case when regexp_matches(lower(coalesce(treat, '')), '\\b({words})\\b') then 'control' else 'treated' end as predicted,
        {_KIND} as kind from (select *, concat_ws(' ', sample_string, treat) as t from samples))"""


def _metric_sql(select: str, tail: str, key: str = "null as kind, null as series_id,", group: str = "") -> str:
    z = "1.959963984540054"
    return f"""with {_labels_sql()}, m as (select kind, series_id, tp, tn, fp, fn, tp + tn + fp + fn as n from (select {key} count(*) filter (gold = 'treated' and predicted = 'treated') as tp,
        count(*) filter (gold = 'control' and predicted = 'control') as tn, count(*) filter (gold = 'control' and predicted = 'treated') as fp, count(*) filter (gold = 'treated' and predicted = 'control') as fn
        from labels where gold is not null {group})), r as (select *, (tp + tn) / nullif(n, 0) as accuracy, tp / nullif(tp + fn, 0) as sensitivity, tn / nullif(tn + fp, 0) as specificity, 2 * tp / nullif(2 * tp + fp + fn, 0) as f1 from m),
        w as (select *, case when n > 0 then greatest(0, (accuracy + {z} * {z} / (2 * n) - {z} * sqrt(accuracy * (1 - accuracy) / n + {z} * {z} / (4 * n * n))) / (1 + {z} * {z} / n)) end as low,
        case when n > 0 then least(1, (accuracy + {z} * {z} / (2 * n) + {z} * sqrt(accuracy * (1 - accuracy) / n + {z} * {z} / (4 * n * n))) / (1 + {z} * {z} / n)) end as high from r)
        select {select} from w {tail}"""


_ROUNDED = ", ".join(f"round({c}, 6) as {c}" for c in [*_METRICS, "low", "high"])
_VOTES = """votes as (select vote_id, case_id, annotator, case x when 'a' then 'A' when 'b' then 'B' when 'both' then 'both' when 'unclear' then 'unclear' end as label from
    (select *, regexp_replace(trim(regexp_replace(lower(choice), '[^a-z]+', ' ', 'g')), '^series ', '') as x from resolver_votes)),
    major as (select case_id, label as majority, n as n_votes from (select case_id, label, count(*) as n from votes where label is not null group by 1, 2) qualify row_number() over (partition by case_id order by n desc, label) = 1)"""
_JUDGED = f"""{_VOTES}, judged as (select case_id, primary_gse, srp_match, majority, claude_choice, gpt_choice, case when claude_choice in ('A', 'B', 'both', 'unclear') then claude_choice = majority end as right_a,
    case when gpt_choice in ('A', 'B', 'both', 'unclear') then gpt_choice = majority end as right_b from resolver_cases join major using (case_id))"""

QUERIES = {f.__name__: f for f in (
    binary_metrics, metrics_by_kind, metrics_long, confusion_table, contingency, low_accuracy_groups, key_field_recall, validity_by_worker, majority_labels, disputed_cases, paired_test, paired_test_p,
    bootstrap_interval, head_to_head, top_confusions, grouping_sets, adjusted_p_values, model_agreement, quality_gate, model_agreement_rate, size_statistics, kind_counts, largest_studies, role_sizes, throughput,
)}

ORACLE_SQL = {
    "binary_metrics": _metric_sql(f"tp, tn, fp, fn, n, {_ROUNDED}", ""),
    "metrics_by_kind": _metric_sql(f"kind, tp, tn, fp, fn, n, {_ROUNDED}", "", key="kind, null as series_id,", group="group by kind"),
    "metrics_long": "select metric, value from (unpivot (" + _metric_sql(", ".join(f"round({c}, 6) as {c}" for c in _METRICS), "") + ") on accuracy, sensitivity, specificity, f1 into name metric value value)",
    "confusion_table": f"with {_labels_sql()} select g.x as gold, p.x as predicted, count(labels.gold) as n from (values ('control'), ('treated')) g(x) cross join (values ('control'), ('treated')) p(x) left join labels on gold = g.x and predicted = p.x group by 1, 2",
    "contingency": "select trtctr_ep, coalesce(gold, '(null)') as gold, count(*) as n from samples group by 1, 2",
    "low_accuracy_groups": _metric_sql("series_id, n, round(accuracy, 6) as accuracy, case when n >= 25 then 'tested' else 'too_few' end as guard", "where accuracy < 0.75", key="null as kind, series_id,", group="group by series_id"),
    "key_field_recall": """select (select count(*) from perturbations) as n_perturbations, (select round(avg((pert_kind not in ('none', 'unclear', 'vehicle_only'))::int), 6) from perturbations) as kind_recall,
        (select count(*) from cell_contexts) as n_contexts, (select round(avg(coalesce(cell_type_or_line_raw <> '', false)::int), 6) from cell_contexts) as cell_recall""",
    "validity_by_worker": """with v as (select worker_id, count(*) as n, count(*) filter (valid_schema) as k from fact_records group by 1), z as (select *, k / n as p, 1.959963984540054 as z from v)
        select worker_id, n, k as n_valid, round(p, 6) as rate, round(greatest(0, (p + z * z / (2 * n) - z * sqrt(p * (1 - p) / n + z * z / (4.0 * n * n))) / (1 + z * z / n)), 6) as low,
        round(least(1, (p + z * z / (2 * n) + z * sqrt(p * (1 - p) / n + z * z / (4.0 * n * n))) / (1 + z * z / n)), 6) as high from z""",
    "majority_labels": f"with {_VOTES} select case_id, majority, n_votes from major",
    "disputed_cases": f"with {_VOTES} select case_id, count(distinct label) as n_labels, count(label) as n_votes from votes group by 1 having count(distinct label) >= 3",
    "paired_test": f"""with {_JUDGED}, t as (select srp_match, count(*) filter (right_a and not right_b) as b, count(*) filter (not right_a and right_b) as c from judged where right_a is not null and right_b is not null group by 1)
        select srp_match, b, c, round((b - c) * (b - c) / nullif(b + c, 0), 6) as chi_square from t""",
    "head_to_head": f"with {_JUDGED} select srp_match, count(*) as n, round(avg(right_a::int), 6) as accuracy_a, round(avg(right_b::int), 6) as accuracy_b, round(avg(right_b::int) - avg(right_a::int), 6) as delta from judged group by 1",
    "top_confusions": f"""with {_JUDGED}, l as (select 'claude' as model, majority, claude_choice as choice from judged union all select 'gpt', majority, gpt_choice from judged),
        n as (select model, majority, choice, count(*) as n from l where choice <> majority group by 1, 2, 3) select model, (row_number() over w - 1)::int as rank, majority, choice, n from n window w as (partition by model order by n desc, majority, choice) qualify rank < 5""",
    "grouping_sets": f"""with {_JUDGED}, l as (select 'claude' as model, srp_match, right_a from judged union all select 'gpt', srp_match, right_b from judged), t as (select model, case when srp_match then 'easy' else 'hard' end as tier, coalesce(right_a, false)::int as ok from l)
        select model, case when grouping(tier) = 1 then 'overall' else tier end as tier, count(*) as n, round(avg(ok), 6) as accuracy from t group by grouping sets ((model), (model, tier))""",
    "adjusted_p_values": f"""with t as (select right(series_id, 1) as g, round(avg(({_GOLD.format('trtctr_ep')} = 'treated')::int) / 20, 6) as p from samples group by 1),
        o as (select g, p, p * (count(p) over () - row_number() over (order by p nulls last, g) + 1) as step, row_number() over (order by p nulls last, g) as r from t)
        select g, p, case when p is not null then round(least(1, max(step) over (order by r)), 6) end as p_holm from o""",
    "model_agreement": f"""with {_VOTES}, l as (select case_id, 'claude' as model, case when claude_choice in ('A', 'B', 'both', 'unclear') then claude_choice end as label from resolver_cases
        union all select case_id, 'gpt', case when gpt_choice in ('A', 'B', 'both', 'unclear') then gpt_choice end from resolver_cases union all select case_id, 'people', majority from major),
        s as (select l.*, primary_gse from l join resolver_cases using (case_id)),
        role as (select a.primary_gse, a.model as model_a, b.model as model_b, avg((a.label is not distinct from b.label)::int) as m from s a join s b on a.primary_gse = b.primary_gse and a.case_id = b.case_id and a.model < b.model group by 1, 2, 3),
        sets as (select primary_gse, model, list_sort(coalesce(list(distinct label) filter (label is not null), [])) as ls from s group by 1, 2),
        p as (select role.*, len(x.ls) = len(y.ls) as k, case when len(list_distinct(x.ls || y.ls)) = 0 then 1.0 else len(list_intersect(x.ls, y.ls)) / len(list_distinct(x.ls || y.ls)) end as j
        from role join sets x on x.primary_gse = role.primary_gse and x.model = model_a join sets y on y.primary_gse = role.primary_gse and y.model = model_b),
        f as (select primary_gse, count(*) as n_pairs, round(avg(0.3 * k::int + 0.5 * m + 0.2 * j), 6) as score from p group by 1)
        select primary_gse, n_pairs, score, case when score >= 0.6 then 'easy' when score >= 0.45 then 'medium' else 'hard' end as tier from f""",
    "quality_gate": _metric_sql("n, case when accuracy >= 0.9 and n >= 100 then 'PASS' when accuracy >= 0.7 then 'BORDERLINE' else 'FAIL' end as gate", ""),
    "model_agreement_rate": """with r as (select srp_match, avg(a) as rate, count(a) as n from (select srp_match, case when claude_choice in ('A', 'B', 'both', 'unclear') and gpt_choice in ('A', 'B', 'both', 'unclear') then (claude_choice = gpt_choice)::int end as a from resolver_cases) group by 1)
        select srp_match, n, round(rate, 6) as rate, case when rate is null then 'not computable' when rate >= 0.85 then 'high' when rate < 0.5 then 'low' else 'between' end as band from r""",
    "size_statistics": """select source, min(strlen(text)) as least, round(quantile_cont(strlen(text), 0.5), 6) as median, round(quantile_cont(strlen(text), 0.99), 6) as p99, max(strlen(text)) as most, sum(strlen(text))::bigint as total from documents group by 1""",
    "kind_counts": "select coalesce(phase, '(null)') as phase, pert_kind, count(*) as n from perturbations group by 1, 2",
    "largest_studies": "select series_id, count(*) as n from samples group by 1 order by n desc, series_id limit 20",
    "role_sizes": f"with g as (select series_id, {_GOLD.format('trtctr_ep')} as role, count(*) as n from samples group by 1, 2) select role, sum(n)::bigint as n_samples, count(*) as n_groups from g group by 1",
    "throughput": """with t as (select worker_id, count(*) as n, (epoch_us(max(ts)) - epoch_us(min(ts))) / 60000000.0 as m from fact_records group by 1)
        select worker_id, n, round(m, 3) as minutes, round(n / nullif(m, 0), 4) as per_minute, round(1000000 / nullif(n / nullif(m, 0), 0), 1) as minutes_for_a_million from t""",
}
