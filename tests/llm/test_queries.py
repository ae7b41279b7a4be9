"""What the numbered queries return."""

import __spark_entry__ as contract
import pytest
from tideglass.llm import catalog

COLUMNS = {
    "op1_": "query_id bigint, rank int, vec_id bigint, score double",
    "op2_": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double",
    "op3_": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, "
    "offset bigint",
    "op4_": "page_id bigint, host string, path string, rule string, verdict string",
    "op5_": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op6_": "doc_id bigint, held_out boolean, score double, predicted int",
    "op7_": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op9_": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
    "contaminated boolean",
    "op10_": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op11_": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
    "base_sha256 string, spans string",
    "op12_": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
    "negative_score bigint",
    "op13_": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
    "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
}


def test_all_are_registered():
    names = set(contract.queries())
    assert set(catalog.QUERIES) <= names and "pipeline" in names
    assert set(catalog.SQL) <= set(contract.oracle_sql())
    assert sorted(name.split("_")[0] for name in catalog.QUERIES) == sorted(p[:-1] for p in COLUMNS)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_columns_and_rows(spark, sf_dir, name):
    found = catalog.QUERIES[name](spark, sf_dir)
    kinds = dict(found.dtypes)
    for column in COLUMNS[name.split("_")[0] + "_"].split(", "):
        label, kind = column.split(" ")
        assert kinds[label] == kind
    assert found.count() > 0
