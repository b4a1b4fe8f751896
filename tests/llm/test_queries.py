"""The registered queries over whole tables, against their SQL where there is some."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tableflow.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = {
    "op1_": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2_": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op3_": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op4_": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op5_": {"doc_id": "bigint", "n_words": "bigint", "n_pieces": "bigint"},
    "op6_": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op7_": {"query_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "double"},
    "op8_": {"doc_id": "bigint", "lines_before": "bigint", "lines_removed": "bigint", "text_md5": "string"},
    "op9_": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
             "sequence_id": "bigint", "offset": "bigint"},
    "op11": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op12": {"doc_id": "bigint", "n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint",
             "output_sha256": "string", "restored_sha256": "string"},
    "op13": {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint",
             "score": "bigint"},
    "op10": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
}


def shown(rows):
    return sorted(tuple(map(str, r)) for r in rows)


@pytest.mark.parametrize("name", [q.__name__ for q in queries.QUERIES])
def test_query(spark, name):
    df = entry.queries()[name](spark, SF)
    assert dict(df.dtypes) == COLUMNS[name[:4]]
    rows = df.collect()
    source = "pages" if name.startswith("op2_") else "documents"
    if not name.startswith(("op4_", "op7_", "op9_", "op13_")):
        assert len(rows) == spark.read.parquet(f"{SF}/{source}.parquet").count()
    assert rows or name.startswith("op13_")  # no phrase of the smallest table is frequent enough in some languages
    if name in queries.ORACLES:
        con = duckdb.connect()
        for path in Path(SF).glob("*.parquet"):
            con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        answer = con.execute(queries.ORACLES[name])
        order = [c[0] for c in answer.description]
        assert sorted(order) == sorted(df.columns)
        assert shown(answer.fetchall()) == shown(tuple(r[c] for c in order) for r in rows)


def test_all_are_registered():
    assert {q.__name__ for q in queries.QUERIES} | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(entry.oracle_sql())
