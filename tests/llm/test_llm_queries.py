import pytest
from conftest import SMALL

from cohortloom.llm import registry

COLUMNS = {"p2_found": ["case_id", "choice"], "p4_found": ["context_id", "field_name", "ref_id"], "p5_found": ["call_id", "defect"], "p6_found": ["doc_id", "item_id"], "p8_found": ["doc_id"]}


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_runs(spark, name):
    df = registry.queries()[name](spark, SMALL)
    assert df.columns == COLUMNS.get(name, df.columns)
    rows = df.collect()
    if name in COLUMNS:
        assert rows and len(set(rows)) == len(rows)
