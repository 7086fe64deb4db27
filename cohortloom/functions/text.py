"""Text rules as Catalyst expressions: canonical forms, keyword classifiers, keys, hashes and prompts.

Null and the empty string are different on disk and the same in these rules unless a docstring says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: control words, ordered kind patterns, vocabularies -----------------------------------
CONTROL_WORDS = (
    "ctrl", "control", "wildtype", "wild-type", "wild type", "wt",
    "dmso", "vehicle", "untreated", "mock", "uninfected", "naive",
    "non-targeting", "scrambled", "sint", "sineg", "shnt",
    "empty vector", "ev", "parental",
)
#: kind, then (pattern, case-insensitive); the first kind with a hit wins.
KIND_PATTERNS = (
    ("factorial", (("factorial", True), (r"\+\w+\s+\+\w+", True), (r"\+\w+\s+-\w+", True))),
    ("mediated_effect", ((r"conditioned\s+media", True), ("transwell", True), ("co-?culture", True), ("paracrine", True), (r"bystander\s+effect", True))),
    ("treatment_vs_untreated", ((r"(\d+\s*[Gg]y\b.*){2,}", False), (r"(0\s*[Gg]y).*(\d+\s*[Gg]y)", False), ("irradiat", True), ("untreated.*treated", True), ("sham.*irradiat", True))),
    ("time_course", ((r"(\d+\s*[hd]\b.*){2,}", True), (r"time\s*course", True), ("kinetic", True))),
    ("knockdown_panel", ((r"\bsiRNA\b", True), (r"\bshRNA\b", True), ("knockdown", True), ("knock-?down", True), (r"\bsi-?[A-Z][A-Z0-9]+\b", False), (r"\bsh-?[A-Z][A-Z0-9]+\b", False), (r"[+-]\s*[Dd]ox\b", False), ("inducible.*[Dd]ox", True), ("[Dd]ox.*induc", True), ("tetracycline.*induc", True))),
    ("knockout_vs_wt", ((r"\bknockout\b", True), (r"\bKO\b", False), ("-/-", False), (r"\+/\+", False), (r"\bWT\b", False), ("wild-?type", True))),
    ("disease_vs_normal", ((r"\bdisease\b", True), (r"\bcancer\b", True), (r"\btumor\b", True), (r"\btumour\b", True), ("patient", True), ("carcinoma", True), ("glioblastoma", True), ("leukemia", True), ("lymphoma", True), ("(healthy|normal).*(control|tissue|cortex|donor)", True))),
    ("treatment_vs_vehicle", ((r"\bDMSO\b", True), (r"\bvehicle\b", True), (r"\bdrug\b", True), ("compound", True), (r"\b\d+\s*[uM]M\b", False), (r"\b\d+\s*nM\b", False))),
)
TREATED_ROLES = ("treated", "perturbed", "case", "secondary_arm")
CONTROL_ROLES = ("control", "vehicle_control", "untreated_control", "negative_genetic_control", "negative_inducer_control", "baseline_t0", "comparison")
NEUTRAL_ROLES = ("bystander", "excluded", "unclear", "positive_control")
GRANULAR_ROLES = ("negative_inducer_control", "baseline_t0", "secondary_arm", "bystander")
METHOD_TAG = r"(?i)\[(scRNA|RNA-Seq|RNA-seq|single-cell|bulk|ATAC|ChIP)|\((scRNA|RNA-seq|bulk|ATAC|ChIP)"
KIND_NAMES = {"cytokine_stimulation": "cytokine_stim", "environmental_or_behavioral": "environmental", "mechanical_or_physical": "mechanical"}
# --------------------------------------------------------------------------------------------------------


def filled(c: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(c != "", F.lit(False))


def composed_text(title: Column, source: Column, characteristics: Column) -> Column:
    """``title: T,source: S,C`` without the empty parts; all empty gives the empty string."""
    return F.concat_ws(",", F.when(filled(title), F.concat(F.lit("title: "), title)), F.when(filled(source), F.concat(F.lit("source: "), source)), F.when(filled(characteristics), characteristics))


def reject_reason(organism: Column, strategy: Column, text: Column, want_organism: str, want_strategy: str, least: int) -> Column:
    """Null for rows to keep, else the first reason; a null organism or strategy is ``unknown``."""
    return (
        F.when(organism.isNull() | strategy.isNull(), "unknown").when(organism != want_organism, "not_human").when(strategy != want_strategy, "not_bulk_rnaseq")
        .when(F.coalesce(F.length(text) < least, F.lit(True)), "string_too_short")
    )


def control_label(text: Column) -> Column:
    """``control`` where a control word stands between word boundaries, else ``treated`` (null text included)."""
    return F.when(F.coalesce(F.lower(text).rlike(r"\b(" + "|".join(CONTROL_WORDS) + r")\b"), F.lit(False)), "control").otherwise("treated")


def kind_patterns(kind: str) -> tuple[str | None, str | None]:
    """(case-insensitive, case-sensitive) alternation of the patterns of a kind."""
    rules = dict(KIND_PATTERNS)[kind]
    loose, strict = [p for p, i in rules if i], [p for p, i in rules if not i]
    return ("(?i)" + "|".join(f"(?:{p})" for p in loose) if loose else None), ("|".join(f"(?:{p})" for p in strict) if strict else None)


def design_kind(text: Column) -> Column:
    """The first kind one of whose patterns hits, else ``unknown``; two regex scans a kind at most."""
    out = F.lit("unknown")
    for kind, _ in reversed(KIND_PATTERNS):
        hits = [text.rlike(p) for p in kind_patterns(kind) if p]
        hit = hits[0] if len(hits) == 1 else hits[0] | hits[1]
        out = F.when(F.coalesce(hit, F.lit(False)), kind).otherwise(out)
    return out


def role_binary(role: Column) -> Column:
    """treated, control or null; a role outside the vocabulary raises an error."""
    return (
        F.when(role.isNull() | role.isin(*NEUTRAL_ROLES), F.lit(None).cast("string"))
        .when(role.isin(*TREATED_ROLES), "treated")
        .when(role.isin(*CONTROL_ROLES), "control")
        .otherwise(F.raise_error(F.concat(F.lit("unknown role: "), role)).cast("string"))
    )


def role_five(role: Column) -> Column:
    """The five coarse roles: treated, control, bystander, excluded and unclear; null stays null."""
    return F.when(role.isin("bystander", "excluded"), role).when(role.isin("unclear", "positive_control"), "unclear").otherwise(role_binary(role))


def super_series(summary: Column) -> Column:
    """Whether a study is only the parent of others."""
    return F.coalesce(summary.startswith("This SuperSeries is composed of"), F.lit(False))


def label_binary(label: Column) -> Column:
    """treated or control for a free label in any case and with blanks, else null."""
    x = F.lower(F.trim(label))
    return F.when(x == "treated", "treated").when(x == "control", "control")


def dose_key(dose: Column) -> Column:
    """Dose without blanks, micro sign as u; ``nodose`` where there is none."""
    return F.when(filled(dose), F.translate(F.regexp_replace(dose, r"\s+", ""), "µ", "u")).otherwise("nodose")


def _digits7(x: Column) -> Column:
    """Seven significant digits without trailing zeros, for 1e-4 <= x < 1e7."""
    places = F.greatest(F.lit(0), F.lit(6) - F.floor(F.log10(F.greatest(x, F.lit(1e-9)))).cast("int"))
    scale = F.pow(F.lit(10.0), places)
    text = F.format_string("%.10f", F.round(x * scale, 0) / scale)
    return F.when(x == 0, F.lit("0")).when(x.isNotNull(), F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", ""))


def duration_key(duration: Column) -> Column:
    """Minutes to hours, days under six to hours, days from six on as days; other texts pass in lower case without blanks; ``na`` for none."""
    t = F.lower(F.regexp_replace(duration, r"\s+", ""))
    n = F.regexp_extract(t, r"^([0-9.]+)([a-z]+)$", 1)
    unit = F.regexp_extract(t, r"^([0-9.]+)([a-z]+)$", 2)
    x = F.when(n.rlike(r"^\d*\.?\d+$|^\d+\.$"), n.cast("double"))
    known = (
        F.when(unit.isin("min", "mins", "minute", "minutes"), F.concat(_digits7(x / 60), F.lit("h")))
        .when(unit.isin("h", "hr", "hrs", "hour", "hours"), F.concat(_digits7(x), F.lit("h")))
        .when(unit.isin("d", "day", "days") & (x < 6), F.concat(_digits7(x * 24), F.lit("h")))
        .when(unit.isin("d", "day", "days"), F.concat(_digits7(x), F.lit("d")))
    )
    return F.when(filled(duration), F.coalesce(known, t)).otherwise("na")


def cell_key(candidate: Column, raw: Column) -> Column:
    """The candidate id, else the raw name, else ``unclear``."""
    return F.coalesce(F.nullif(candidate, F.lit("")), F.nullif(raw, F.lit("")), F.lit("unclear"))


def kind_name(kind: Column) -> Column:
    """The key's name of a perturbation kind."""
    pairs = [F.lit(x) for kv in KIND_NAMES.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[kind], kind)


def agent_key(identifier: Column, database: Column, name: Column) -> Column:
    """The id, else ``database:name``, else the name, else ``unknown``."""
    name = F.coalesce(F.nullif(name, F.lit("")), F.lit("unknown"))
    return F.when(filled(identifier), identifier).when(filled(database), F.concat_ws(":", database, name)).otherwise(name)


def variant_key(modifications: str) -> Column:
    """Label of the first modification that isn't wild type and has a label, else ``wt``."""
    hit = F.filter(F.col(modifications), lambda m: (m["variant"]["is_wildtype"] == F.lit(False)) & (m["variant"]["label"] != ""))
    return F.coalesce(F.get(hit, F.lit(0))["variant"]["label"], F.lit("wt"))


def anchor_key(fact: str, role: Column) -> Column:
    """The thirteen-segment key that makes comparisons of different studies groupable.

    A disease contrast (role case or comparison, or a disease status without an active perturbation) overrides
    kind, agent and variant; a mediated effect takes its kind and first target; only the first perturbation counts.
    """
    f = F.col(fact)
    perts = F.coalesce(f["perturbations"], F.array())
    first = F.get(f["perturbations"], F.lit(0))
    agent, mediated = first["agent_normalized"], first["mediated_effect"]
    status = f["disease_state"]["status"]
    active = F.exists(perts, lambda p: ~F.coalesce(p["kind"], F.lit("unclear")).isin("none", "vehicle_only", "unclear"))
    disease = F.coalesce(role.isin("case", "comparison"), F.lit(False)) | (F.coalesce(status.isin("case", "comparison", "disease_model"), F.lit(False)) & ~active)
    is_mediated = mediated["kind"].isNotNull() | (F.size(F.coalesce(mediated["targets"], F.array().cast("array<string>"))) > 0)
    context = f["cell_context"]
    kind = F.when(disease, F.lit("disease_vs_normal")).when(is_mediated, kind_name(F.coalesce(mediated["kind"], first["kind"], F.lit("unclear")))).otherwise(kind_name(F.coalesce(first["kind"], F.lit("none"))))
    target = F.concat(F.lit("HGNC:"), F.coalesce(F.nullif(F.get(mediated["targets"], F.lit(0)), F.lit("")), F.lit("unknown")))
    agent_part = (
        F.when(disease, F.coalesce(F.nullif(f["disease_state"]["mesh_id_candidate"], F.lit("")), F.lit("unknown")))
        .when(is_mediated, target)
        .otherwise(F.when(first.isNull(), F.lit("none")).otherwise(agent_key(agent["id"], agent["id_database"], agent["preferred_name"])))
    )
    variant = F.when(disease, F.lit("wt")).otherwise(variant_key(f"{fact}.cell_context.engineered_modifications"))
    disease_status = F.when(F.coalesce(role.isin("case", "comparison"), F.lit(False)), role).otherwise(F.coalesce(F.nullif(status, F.lit("")), F.lit("none")))
    engineered = F.size(F.coalesce(context["engineered_modifications"], F.array())) > 0
    return F.concat_ws(
        "|", kind, agent_part, variant, dose_key(first["dose"]["value_raw"]), duration_key(first["duration"]["value_raw"]), F.coalesce(first["phase"], F.lit("exposure")),
        cell_key(context["cell_line_cellosaurus_candidate"], context["cell_type_or_line_raw"]), F.coalesce(context["context_kind"], F.lit("unclear")), F.coalesce(context["cell_state"], F.lit("proliferating")),
        F.coalesce(context["subcellular_fraction"]["kind"], F.lit("whole_cell")), F.coalesce(F.nullif(context["tissue"], F.lit("")), F.lit("na")), disease_status, engineered.cast("string"),
    )


def cache_key(version: str, text: Column) -> Column:
    return F.concat(F.lit(f"{version}:"), F.sha2(text, 256))


def seed_of(key: Column, seed: int) -> Column:
    """A positive seed from the first seven hex digits of an md5."""
    return F.greatest(F.lit(1).cast("long"), F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{seed}"))), 1, 7), 16, 10).cast("long"))


def split_list(text: Column, separator: str = ",") -> Column:
    """Trimmed non-empty parts of a separated list; null gives null."""
    return F.filter(F.transform(F.split(text, separator), lambda s: F.trim(s)), lambda s: s != "")


def slug(text: Column, length: int = 24) -> Column:
    """Lower case, runs of other characters as one hyphen, trimmed and cut; null for nothing."""
    x = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.nullif(F.regexp_replace(F.substring(x, 1, length), "-+$", ""), F.lit(""))


def short_run_id(run_id: Column) -> Column:
    """A run id without its first and last hyphenated part; ids of fewer than three parts stay."""
    parts = F.split(run_id, "-")
    return F.when(F.size(parts) >= 3, F.array_join(F.slice(parts, F.lit(2), F.size(parts) - 2), "-")).otherwise(run_id)


def render(template: Column, values: dict[str, Column]) -> Column:
    """A template with its ``__NAME__`` placeholders filled; one that stays open raises an error."""
    out = template
    for name, value in values.items():
        out = F.replace(out, F.lit(f"__{name}__"), value)
    return F.when(F.size(F.regexp_extract_all(out, F.lit("__[A-Z_]+__"), F.lit(0))) > 0, F.raise_error(F.concat(F.lit("open placeholder: "), out)).cast("string")).otherwise(out)


def base_id(record_id: Column) -> Column:
    """A record id without its chunk and re-split suffixes."""
    return F.regexp_replace(F.regexp_replace(record_id, "#.*$", ""), "--rsc.*$", "")


def failure_mode(raw: Column) -> Column:
    """A: tabs run on at the end; B: long without a run of blanks or dots; else other. Null gives other."""
    tail = F.substring(raw, F.greatest(F.lit(1), F.length(raw) - 50), F.lit(51))
    tabs = F.length(tail) - F.length(F.translate(tail, "\t", ""))
    return F.when(F.coalesce(tabs >= 20, F.lit(False)), "A").when(F.coalesce((F.length(raw) >= 2400) & ~raw.rlike(r"[\s.]{30}"), F.lit(False)), "B").otherwise("other")


def scraped_field(raw: Column, name: str) -> Column:
    """A string field read out of broken JSON by its pattern, or null."""
    return F.nullif(F.regexp_extract(raw, f'"{name}"\\s*:\\s*"([^"]+)"', 1), F.lit(""))


def without_fence(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"^\s*```[ ]*[A-Za-z]*\s*", ""), r"\s*```\s*$", "")


def tolerant_json(text: Column) -> Column:
    """The trimmed text if it is a JSON value, else the span from the first { to the last }, else null."""
    t = F.trim(text)
    span = F.regexp_extract(t, r"(?s)\{.*\}", 0)
    return F.when(F.try_parse_json(t).isNotNull(), t).when(F.try_parse_json(span).isNotNull(), span)


def token_estimate(text: Column) -> Column:
    """At least one token, a token for each four bytes begun."""
    return F.greatest(F.lit(1).cast("long"), F.ceil(F.octet_length(F.coalesce(text, F.lit(""))) / 4))


def size_tier(bytes_: Column) -> Column:
    return F.when(bytes_ < 15360, "S").when(bytes_ < 25600, "M").when(bytes_ < 35840, "L").otherwise("XL")


def tier_tokens(tier: Column) -> Column:
    return F.when(tier == "S", 4096).when(tier == "M", 8192).when(tier == "L", 16384).when(tier == "XL", 32768)


def clock_seconds(text: Column) -> Column:
    """Seconds of ``[D-]HH:MM:SS``; null for another form."""
    ok = text.rlike(r"^(\d+-)?\d+:\d{1,2}:\d{1,2}$")
    day = F.regexp_extract(text, r"^(\d+)-", 1)
    parts = F.split(F.regexp_replace(text, r"^\d+-", ""), ":")
    return F.when(ok, F.when(day != "", day.cast("long")).otherwise(0) * 86400 + parts[0].cast("long") * 3600 + parts[1].cast("long") * 60 + parts[2].cast("long"))


def clock_text(seconds: Column) -> Column:
    s = seconds.cast("long")
    return F.when(s.isNotNull(), F.format_string("%02d:%02d:%02d", F.floor(s / 3600).cast("int"), (F.floor(s / 60) % 60).cast("int"), (s % 60).cast("int")))


def pair_key(a: Column, b: Column) -> Column:
    """The unordered pair as ``smaller|larger``; null if either is."""
    return F.concat(F.least(a, b), F.lit("|"), F.greatest(a, b))


def messages(system: Column, user: Column) -> Column:
    return F.array(F.struct(F.lit("system").alias("role"), system.alias("content")), F.struct(F.lit("user").alias("role"), user.alias("content")))


def split_system(messages_: Column) -> tuple[Column, Column]:
    """(system texts joined by a blank line, the other messages)."""
    system = F.array_join(F.transform(F.filter(messages_, lambda m: m["role"] == "system"), lambda m: m["content"]), "\n\n")
    return system, F.filter(messages_, lambda m: m["role"] != "system")


def study_prompt(series: Column, summary: Column, samples: Column, part: Column, parts: Column, total: Column) -> Column:
    """Prompt lines of a study's samples as compact JSON; the lines of a chunk only where there are several, and of the total where it is known."""
    chunk = F.when(part.isNotNull() & parts.isNotNull(), F.concat(F.lit("chunk: "), part.cast("string"), F.lit("/"), parts.cast("string")))
    whole = F.when(total.isNotNull(), F.concat(F.lit("study_total_samples: "), total.cast("string")))
    return F.concat_ws("\n", F.concat(F.lit("series_id: "), series), chunk, whole, F.concat(F.lit("study_summary: "), F.coalesce(summary, F.lit(""))), F.lit("samples:"), F.to_json(samples, {"ignoreNullFields": "false"}))


def schema_prompt(template: str, schema: dict, record_id: Column, text: Column) -> Column:
    """A prompt of any task: template, the schema with sorted keys, the record's id and text."""
    import json

    head = f"{template.strip()}\n\nReturn exactly one JSON object matching this schema.\n{json.dumps(schema, indent=2, sort_keys=True)}\n\nRecord ID: "
    return F.concat(F.lit(head), record_id.cast("string"), F.lit("\nRecord text:\n"), F.coalesce(text, F.lit("")), F.lit("\n\nJSON:"))


def fact_prompt(accession: Column, series: Column, text: Column) -> Column:
    """Prompt lines of one sample; null lines are left out."""
    return F.concat_ws("\n", F.concat(F.lit("sample: "), accession), F.concat(F.lit("study: "), series), F.concat(F.lit("text: "), text))
