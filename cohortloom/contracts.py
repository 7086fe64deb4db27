"""Declared schemas of the nested records. The field names and types are fixed values of the data contract."""

from __future__ import annotations

from pyspark.sql import types as T

from .operators.nested_contract import Arr, Leaf, Obj

FACT_DDL = """
geo_accession STRING, series_id STRING, organism STRING, host_organism STRING,
cell_context STRUCT<cell_type_or_line_raw: STRING, cell_line_cellosaurus_candidate: STRING, tissue: STRING, tissue_segment: STRING,
  passage_or_state: STRING, context_kind: STRING, developmental_stage: STRING, cell_state: STRING,
  subcellular_fraction: STRUCT<kind: STRING, raw: STRING>,
  engineered_modifications: ARRAY<STRUCT<kind: STRING, label: STRING, variant: STRUCT<label: STRING, description: STRING, is_wildtype: BOOLEAN>>>,
  co_culture_partners: ARRAY<STRUCT<cell_type: STRING, source_organism: STRING, modifications: ARRAY<STRING>, role: STRING>>,
  sort_markers: ARRAY<STRING>, cell_composition_estimates: ARRAY<STRUCT<marker: STRING, proportion: DOUBLE, method: STRING>>>,
disease_state STRUCT<term_raw: STRING, mesh_id_candidate: STRING, status: STRING>,
perturbations ARRAY<STRUCT<kind: STRING, agent_raw: STRING,
  agent_normalized: STRUCT<type: STRING, id_database: STRING, id: STRING, preferred_name: STRING, collection: STRUCT<name: STRING, id_in_collection: STRING>>,
  dose: STRUCT<value_raw: STRING, value_numeric: DOUBLE, unit: STRING>,
  duration: STRUCT<value_raw: STRING, value_hours: DOUBLE, is_zero_timepoint: BOOLEAN>,
  phase: STRING, temporal_order: INT, is_negative_control: BOOLEAN, mediated_effect: STRUCT<kind: STRING, targets: ARRAY<STRING>>>>,
technical_treatments ARRAY<STRUCT<kind: STRING, agent_raw: STRING>>,
patient_metadata STRUCT<donor_id: STRING, age: DOUBLE, sex: STRING, ancestry_or_population: STRING, ancestry_admixture: DOUBLE, clinical_response: STRING,
  survival_group: STRING, stage: STRING, condition: STRING, visit_or_timepoint: STRING>,
extraction STRUCT<schema_version: STRING, model: STRING, confidence: DOUBLE, ambiguity_flags: ARRAY<STRING>, raw_input_hash: STRING>
"""


def fact_schema() -> T.StructType:
    return T._parse_datatype_string(FACT_DDL)


DESIGN_DDL = """
series_id STRING, design_summary STRING, design_kind STRING, factors ARRAY<STRUCT<name: STRING, type: STRING, levels: ARRAY<STRING>>>,
replicate_groups ARRAY<STRUCT<group_id: STRING, label_human: STRING, sample_ids: ARRAY<STRING>, primary_role: STRING, factor_levels: ARRAY<STRUCT<key: STRING, value: STRING>>>>,
comparisons ARRAY<STRUCT<comparison_id: STRING, treated_group: STRING, control_group: STRING, control_type: STRING, design_kind: STRING, varying_factor: STRING,
  fixed_factors: ARRAY<STRUCT<key: STRING, value: STRING>>, study_internal_score: DOUBLE>>,
extraction STRUCT<schema_version: STRING, model: STRING, confidence: DOUBLE, ambiguity_flags: ARRAY<STRING>, input_sample_count: INT, input_truncated: BOOLEAN>
"""


def design_schema() -> T.StructType:
    return T._parse_datatype_string(DESIGN_DDL)


#: Keys that a complete fact always has.
FACT_SIGNATURE = frozenset({"geo_accession", "cell_context", "extraction"})


def _enum(text: str, null: bool = False) -> Leaf:
    return Leaf(null=null, enum=tuple(text.split()))


_TEXT, _MAYBE, _SHARE = Leaf(), Leaf(null=True), Leaf("number", low=0, high=1)
# --- fixed values: the closed contracts of facts and designs ----------------------------------------------
_EXTRACTION = {"model": Leaf(least_length=1), "confidence": _SHARE}
FACT_CONTRACT = Obj({
    "geo_accession": Leaf(least_length=1), "series_id": Leaf(least_length=1), "organism": _MAYBE, "host_organism": _MAYBE,
    "cell_context": Obj({
        "cell_type_or_line_raw": _MAYBE, "cell_line_cellosaurus_candidate": _MAYBE, "tissue": _MAYBE, "tissue_segment": _MAYBE, "passage_or_state": _MAYBE,
        "context_kind": _enum("cell_line_in_vitro primary_culture iPSC_derived organoid xenograft primary_tissue pdx_derived_cell_line co_culture tumor_extracted_cells unclear"),
        "developmental_stage": _MAYBE,
        "cell_state": _enum("proliferating senescent quiescent dormant activated anergic exhausted naive memory differentiated dedifferentiated undifferentiated transitional apoptotic stressed recovering unclear none", null=True),
        "subcellular_fraction": Obj({"kind": _enum("ER nuclear cytoplasmic chromatin mitochondrial membrane polysome monosome ribosome_associated exosome total_rna other"), "raw": _TEXT}, null=True),
        "engineered_modifications": Arr(Obj({
            "kind": _enum("germline_genotype crispr_stable transgene_stable inducible_transgene drug_adapted reporter_stable other"), "label": _MAYBE,
            "variant": Obj({"label": _MAYBE, "description": _MAYBE, "is_wildtype": Leaf("boolean")}, null=True),
        })),
        "co_culture_partners": Arr(Obj({"cell_type": _TEXT, "source_organism": _MAYBE, "modifications": Arr(_TEXT), "role": _enum("feeder partner target stromal")})),
        "sort_markers": Arr(_TEXT),
        "cell_composition_estimates": Arr(Obj({"marker": _TEXT, "proportion": Leaf("number", null=True, low=0, high=1), "method": _MAYBE})),
    }),
    "disease_state": Obj({"term_raw": _MAYBE, "mesh_id_candidate": _MAYBE, "status": _enum("case comparison disease_model none")}),
    "perturbations": Arr(Obj({
        "kind": _enum("small_molecule vehicle_only genetic_knockdown genetic_knockout genetic_overexpression crispra_activation crispri_repression cytokine_stimulation pathogen_or_aggregate_exposure environmental_or_behavioral differentiation mechanical_or_physical none unclear"),
        "agent_raw": _MAYBE,
        "agent_normalized": Obj({
            "type": _enum("gene_or_protein small_molecule vehicle disease_term genotype none other"),
            "id_database": _enum("HGNC MGI UniProt DrugBank ChEMBL CHEBI MeSH CAS Cellosaurus Ensembl NCBITaxonomy", null=True),
            "id": _MAYBE, "preferred_name": _MAYBE, "collection": Obj({"name": _TEXT, "id_in_collection": _TEXT}, null=True),
        }),
        "dose": Obj({"value_raw": _MAYBE, "value_numeric": Leaf("number", null=True), "unit": _MAYBE}),
        "duration": Obj({"value_raw": _MAYBE, "value_hours": Leaf("number", null=True), "is_zero_timepoint": Leaf("boolean")}),
        "phase": _enum("exposure washout recovery persistence rebound", null=True), "temporal_order": Leaf("integer", null=True, low=1), "is_negative_control": Leaf("boolean"),
        "mediated_effect": Obj({"kind": _enum("genetic_overexpression genetic_knockdown genetic_knockout crispra_activation crispri_repression small_molecule other"), "targets": Arr(_TEXT)}, null=True),
    })),
    "technical_treatments": Arr(Obj({"kind": _enum("culture_matrix culture_media electroporation_method rna_fractionation subcellular_isolation cell_synchronization chip_or_clip_setup batch_or_processing other_technical"), "agent_raw": _MAYBE})),
    "patient_metadata": Obj({
        "donor_id": _MAYBE, "age": Leaf("number", null=True), "sex": _enum("M F other", null=True), "ancestry_or_population": _MAYBE, "ancestry_admixture": Leaf("number", null=True, low=0, high=1),
        "clinical_response": _MAYBE, "survival_group": _MAYBE, "stage": _MAYBE, "condition": _MAYBE, "visit_or_timepoint": _MAYBE,
    }, null=True),
    "extraction": Obj({
        "schema_version": Leaf(const="stage1.v3"), **_EXTRACTION,
        "ambiguity_flags": Arr(_enum("missing_dose missing_duration time_zero_timepoint multi_factor_in_string compound_unmapped cell_line_ambiguous vehicle_only description_too_short mixed_organism_terms study_specific_jargon multiple_perturbations engineered_cell_line technical_treatment_only disease_state_present control_unspecified post_treatment_ambiguous protocol_only_no_perturbation metadata_inconsistency opaque_compound_code")),
        "raw_input_hash": Leaf(pattern="^sha256:[0-9a-f]{64}$"),
    }),
})
_DESIGN_KIND = _enum("case_control_disease treatment_vs_vehicle treatment_vs_untreated time_course dose_response knockdown_panel factorial differentiation_course multi_arm_treatment unclear")
_PAIRS = Arr(Obj({"key": _TEXT, "value": _TEXT}))
DESIGN_CONTRACT = Obj({
    "series_id": Leaf(pattern="^GSE[0-9]+$"), "design_summary": Leaf(least_length=10), "design_kind": _DESIGN_KIND,
    "factors": Arr(Obj({"name": _TEXT, "type": _enum("stimulation small_molecule genetic time dose cell_line donor condition other"), "levels": Arr(_TEXT, least=1)})),
    "replicate_groups": Arr(Obj({"group_id": _TEXT, "label_human": _TEXT, "sample_ids": Arr(_TEXT, least=1), "primary_role": _enum("treated control bystander excluded unclear"), "factor_levels": _PAIRS}), least=1),
    "comparisons": Arr(Obj({
        "comparison_id": _TEXT, "treated_group": _TEXT, "control_group": _TEXT, "control_type": _enum("vehicle untreated genetic_negative inducer_off disease_normal time_zero secondary_arm"),
        "design_kind": _DESIGN_KIND, "varying_factor": _TEXT, "fixed_factors": _PAIRS, "study_internal_score": _SHARE,
    })),
    "extraction": Obj({
        "schema_version": Leaf(const="stage2.v2"), **_EXTRACTION, "model": _TEXT, "ambiguity_flags": Arr(_TEXT), "input_sample_count": Leaf("integer", low=1), "input_truncated": Leaf("boolean"),
    }),
})
# ---------------------------------------------------------------------------------------------------------
