"""The pipeline against plain Python, stage by stage, and each stage on awkward rows."""

from __future__ import annotations

from collections import Counter

import brute
import duckdb
import numpy as np
import pytest

import corpus_pipeline
from lendscope.llm import pieces, toxicity
from lendscope.llm.queries import TOXIC_FROM, model_bytes


def plain_score(text: str | None, model: toxicity.Model) -> float:
    x = np.array(toxicity.features(text, toxicity.Lexicon(model.weights)))
    return float(1 / (1 + np.exp(-(x @ model.coefficients + model.bias))))


def test_run(spark, small):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{small}/documents.parquet' ORDER BY doc_id").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{small}/benchmark.parquet'").fetchall()
    frame = spark.read.parquet(f"{small}/documents.parquet")
    model = toxicity.fit(frame.select("doc_id", "text"), spark.read.parquet(f"{small}/labels.parquet"))
    docs = [(i, t) for i, t in docs if plain_score(t, model) < TOXIC_FROM]
    docs = [(i, t) for i, t, _ in brute.dedup_lines(docs)]
    prints = [(i, brute.simhash(t)) for i, t in docs]
    docs = [d for d, least in zip(docs, brute.component_ids(prints), strict=True) if d[0] == least]
    table = brute.windows(items)
    docs = [(i, t) for i, t in ((i, brute.without_hits(t, table)) for i, t in docs) if t is not ...]
    sp = pieces.processor(model_bytes())
    expected = {i: tuple(sp.encode(t or "")) for i, t in docs}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, small).collect()}
    assert {i: tuple(r["ids"]) for i, r in got.items()} == expected
    for i, ids in expected.items():
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), brute.sha(",".join(map(str, ids))))
        assert got[i].decoded_sha256 == brute.sha(sp.decode(list(ids)))


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stage_on_awkward_rows(spark, small, messy, empty, texts, name, stage):
    out = stage(spark, messy, small)
    rows = out.collect()
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.schema.simpleString() == messy.schema.simpleString()
        assert all(r.n_chars == len(r.text or "") for r in rows)
        assert all(r._row == 3 and r.spans == "s" and r.host == "h" for r in rows)
    if name in ("toxicity", "line_dedup", "benchmark_decontamination", "sentencepiece"):
        assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in texts)
    assert stage(spark, empty, small).collect() == []
