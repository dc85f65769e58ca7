"""Registered queries, whole-table results beside SQL, and the pipeline beside its operators."""

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from skyloom.llm import exact, leaks, near, packing, toxicity
from skyloom.llm.common import read_table
from tools.check import TABLES, normal

FOLDER = "/root/testdata/sf0.001"
NAMES = ["op1_toxicity", "op2_substring_dedup", "op3_decontamination", "op4_licence_scan", "op5_token_files", "op6_secret_scan", "op7_near_dedup", "op8_url_filter", "op9_best_fit_packing", "op10_exact_dedup",
         "op11_whitening", "op12_ranked_search", "op13_simhash"]


def test_every_operator_has_one_query():
    names = [n for n in entry_points.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(names) == sorted(NAMES) and "pipeline" in entry_points.queries()


@pytest.mark.parametrize("name", [n for n in NAMES if n in entry_points.oracle_sql()])
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    got, want = entry_points.queries()[name](spark, FOLDER).toPandas(), con.execute(entry_points.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and normal(got) == normal(want)


@pytest.mark.parametrize("name", ["op1_toxicity", "op2_substring_dedup", "op5_token_files", "op6_secret_scan", "op7_near_dedup", "op10_exact_dedup", "op13_simhash"])
def test_one_row_for_each_document(spark, name):
    ids = [r.doc_id for r in entry_points.queries()[name](spark, FOLDER).select("doc_id").collect()]
    assert sorted(ids) == sorted(r.doc_id for r in read_table(spark, FOLDER, "documents").select("doc_id").collect())


def test_pipeline_is_its_operators_one_after_the_other(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    docs = read_table(spark, FOLDER, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in toxicity.score_documents(docs, read_table(spark, FOLDER, "labels")).where("predicted = 1").collect()}
    left = {i: t for i, t in rows.items() if i not in toxic}
    last = {}
    for i, t in sorted(left.items()):
        last[t] = i
    left = {i: t for t, i in last.items()}
    table = docs.where(docs.doc_id.isin(list(left)))
    assert {r.doc_id for r in exact.exact_groups(docs.where(~docs.doc_id.isin(list(toxic))), exact.newest_batch()).where("kept").collect()} == set(left)
    left = {r.doc_id: left[r.doc_id] for r in near.near_classes(table).where("kept").collect()}
    leaking = {r.doc_id for r in leaks.find_leaks(docs.where(docs.doc_id.isin(list(left))), read_table(spark, FOLDER, "benchmark")).collect()}
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in pieces} == set(left) - leaking
    want = packing.pack_documents(docs.where(docs.doc_id.isin(list(set(left) - leaking))), packing.default_tokenizer()).collect()
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in pieces) == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in want)


def test_stages_take_other_columns_and_empty_tables(spark):
    docs = read_table(spark, FOLDER, "documents").selectExpr("*", "1 AS own", "'x' AS digest", "2 AS id", "3 AS leaking").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == 0
