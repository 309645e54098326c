"""Every registered query of the text problems runs on the smallest data with the columns asked for."""

import pytest

import __spark_entry__ as entry
from paperloom.llm.queries import QUERIES

COLUMNS = {
    "p1_found": "word_id bigint, label_id bigint", "p2_found": "page_id bigint, block_idx int, lang string", "p3_found": "page_id bigint, kind string",
    "p5_found": "word_id bigint, kind string", "p6_ids": "doc_id bigint, ids array<int>", "p7_found": "item_id bigint, doc_id bigint", "p8_found": "doc_id bigint",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, name):
    df = entry.queries()[name](spark, data)
    if name in COLUMNS:
        assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == COLUMNS[name]
    rows = df.collect()
    assert len(rows) > 0
    if name.endswith("_found"):
        assert len(rows) == len(set(rows))
