"""Every registered query on the small tables: columns, whole tables, SQL twins."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="benchmark tables are not here")

COLUMNS = {
    "op1": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op2": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op3": "doc_id held_out score predicted",
    "op4": "doc_id n_tokens rate",
    "op5": "doc_id held_out score predicted",
    "op6": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op7": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op8": "doc_id n_shingles component_id",
    "op9": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op10": "doc_id held_out lang_pred score",
    "op11": "doc_id piece start length ids_crc32 sequence_id offset",
    "op12": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op13": "item_id rank doc_id score",
}
NAMES = [n for n in contract.queries() if n.startswith("op") and n.split("_")[0] in COLUMNS]


def cell(v):
    return "NULL" if v is None or (isinstance(v, float) and math.isnan(v)) else str(v)


def test_all_operators_and_the_pipeline():
    assert len(NAMES) == 13 and "pipeline" in contract.queries()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    df = contract.queries()[name](spark, str(SF))
    rows = df.collect()
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(df.columns)
    ids = [r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    if name.startswith("op11_"):
        assert {r["doc_id"] for r in rows} == set(ids)
    elif not name.startswith("op13_"):
        assert sorted(r["doc_id"] for r in rows) == sorted(ids)
    if "score" in df.columns and not name.startswith(("op1_", "op13_")):
        assert all(0 <= r["score"] <= 1 for r in rows)
    if name in contract.oracle_sql():
        con = duckdb.connect()
        for t in ("documents", "benchmark", "labels"):
            con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
        twin = con.execute(contract.oracle_sql()[name])
        names = [d[0] for d in twin.description]
        assert sorted(names) == sorted(df.columns)
        want = sorted(tuple(cell(r[names.index(c)]) for c in df.columns) for r in twin.fetchall())
        assert sorted(tuple(cell(r[c]) for c in df.columns) for r in rows) == want
