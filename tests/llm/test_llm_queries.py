import pytest
from oracle import differs

from pulsegrid.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, data, name):
    assert differs(spark, QUERIES[name], SQL[name], data) is None


def test_queries_agree_with_each_other(spark, data):
    documents = spark.read.parquet(f"{data}/documents.parquet")
    ids = {r.doc_id: len(r.ids) for r in QUERIES["p7_ids"](spark, data).collect()}
    assert len(ids) == documents.count()
    by_source = QUERIES["p7_tokens_by_source"](spark, data).collect()
    assert sum(r.n_documents for r in by_source) == len(ids) and sum(r.n_tokens for r in by_source) == sum(ids.values()) and max(r.most_tokens for r in by_source) == max(ids.values())
    packed = QUERIES["p8_pack"](spark, data).collect()
    assert {r.doc_id for r in packed} == {d for d, n in ids.items() if n}
    unused = QUERIES["p8_unused"](spark, data).collect()
    assert {(r.pack_id, r.n_tokens) for r in unused} == {(r.pack_id, sum(ids.values())) for r in unused} and all((r.n_containers - 1) * r.capacity_tokens < 1.1 * r.n_tokens and (r.capacity_tokens == 512 or r.moved_share < 0.5) for r in unused)  # at 512 a hundred documents leave little choice
    flags = {r.doc_id: r.cause for r in QUERIES["p9_flags"](spark, data).collect()}
    found = {r.doc_id for r in QUERIES["p9_found"](spark, data).collect()}
    assert flags.keys() == ids.keys() and found == {d for d, c in flags.items() if c} and 0 < len(found) < 0.4 * len(ids)
    report = QUERIES["p9_report"](spark, data).collect()
    assert sum(r.n_cut for r in report) == len(found) and sum(r.n_documents for r in report) == len(ids)
    dull = {r.doc_id for r in documents.filter("text is null or trim(text) = ''").collect()}
    assert not dull & found and all(ids[d] == 0 for d in dull if d in {r.doc_id for r in documents.filter("coalesce(text, '') = ''").collect()})
