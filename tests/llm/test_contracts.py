"""The registered queries on test data: against DuckDB, brute force and held-out labels."""

from __future__ import annotations

import brute
import duckdb
import pytest
from parity import difference, duck, oracle_rows, spark_rows

from lendscope.llm import pieces
from lendscope.llm.queries import ORACLES, QUERIES, model_bytes


def documents(sf_dir: str) -> list[tuple]:
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, small, name):
    assert difference(spark_rows(QUERIES[name](spark, small)), oracle_rows(duck(small), ORACLES[name])) == ""


def test_pieces(spark, small):
    sp = pieces.processor(model_bytes())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op3_pieces"](spark, small).collect()}
    for doc_id, text in documents(small):
        ids = sp.encode(text)
        assert got.pop(doc_id) == (len(ids), brute.sha(",".join(map(str, ids))), brute.sha(sp.decode(ids)))
    assert not got


def test_token_counts(spark, small):
    sp = pieces.processor(model_bytes())
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op8_token_counts"](spark, small).collect()}
    expected = {i: (len(t.encode()), n := len(sp.encode(t)), n > 4096) for i, t in documents(small)}
    assert got == expected


def test_simhash(spark, small):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op9_simhash"](spark, small).collect()}
    prints = [(i, brute.simhash(t)) for i, t in documents(small)]
    expected = {i: (f"{f:016x}", c) for (i, f), c in zip(prints, brute.component_ids(prints), strict=True)}
    assert got == expected


@pytest.mark.parametrize(("name", "label", "least"), [("op1_quality", "quality", 0.95), ("op5_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, name, label, least):
    sf_dir = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES[name](spark, sf_dir).collect()}
    labels = duckdb.sql(f"SELECT doc_id, {label} FROM '{sf_dir}/labels.parquet'").fetchall()
    held = [(rows[i].predicted, y) for i, y in labels if rows[i].held_out]
    assert len(held) > 500 and sum(p == y for p, y in held) >= least * len(held)
    for side in (0, 1):
        own = [p == y for p, y in held if y == side]
        assert sum(own) >= 0.85 * len(own)


def test_url_filter_reads_every_page(spark, small):
    rows = QUERIES["op7_url_filter"](spark, small)
    assert {"page_id", "host", "path", "rule", "verdict"} <= set(rows.columns)
    assert rows.count() == duckdb.sql(f"SELECT count(*) FROM '{small}/pages.parquet'").fetchall()[0][0]
