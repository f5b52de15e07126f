from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

LONG = " ".join(f"word{i} x{i % 7}" for i in range(60_000))


@pytest.fixture(scope="session")
def messy(spark):
    """NULL ids and texts, empty and very long texts, repeated rows and ids, and columns whose names operators use."""
    repeated = "one two three\nfour five six\nseven eight nine\nten eleven twelve"
    rows = [
        (1, "alpha beta gamma delta"), (2, None), (3, ""), (4, "alpha  beta\tgamma delta"), (4, "alpha  beta\tgamma delta"), (5, LONG), (6, LONG + " tail"),
        (7, repeated), (8, "head\n" + repeated + "\nend"), (9, "\n\n\n\n\n\n"), (10, "a\na\na\na\na\na"), (None, "no id at all"), (None, repeated), (None, None), (11, "Ünïcode ▁ wörds <s> \u0000 \U0001f600 \u200b"),
        (12, "   leading and trailing   "), (13, "alpha beta gamma delta"), (5, "another text of a used id"), (14, "tab\tfeed\x0b\x0creturn\r\n"), (15, "\n"), (16, " "), (17, "▁▁ x▁y"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp long, component_id long, spans string, _row int, _id int, _0 int, n_lines int, score string, n_words int, host string, x int, line string"
    return spark.createDataFrame([(i, t, "en", None, len(t or ""), 1, 2, "s", 3, 4, 5, 6, "q", 7, "h", 8, "l") for i, t in rows], schema)


@pytest.fixture(scope="session")
def empty(messy):
    return messy.limit(0)


@pytest.fixture(scope="session")
def texts(messy):
    return [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
