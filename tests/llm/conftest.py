from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

SENTENCE = "the quick brown fox jumps over the lazy dog while seven grey owls look on in silence"
EXTRA = ["id", "th", "span", "spans", "fp", "key", "part", "dedup", "mix", "language", "ident", "content", "h"]
EXTRA += ["deal", "next", "guest", "order", "rid", "component", "row", "c0"]


def edge_rows() -> list[tuple]:
    """NULLs, empty texts, ties, repeated rows, texts that share passages,
    one long text, and letters beyond ASCII."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(4000))
    return [
        (5, SENTENCE + " and five more words follow here"),
        (3, "Before it. " + SENTENCE),
        (3, "Before it. " + SENTENCE),  # a repeated row
        (3, "another text under the same identifier: " + SENTENCE),
        (9, None),
        (8, ""),
        (7, " \t\n"),
        (None, SENTENCE),
        (None, None),
        (12, long),
        (11, long + " tail"),
        (14, SENTENCE + " " + SENTENCE + " " + SENTENCE),
        (15, "é" * 120 + " ünïcode Ünïcode straße " + "é" * 120),
        (16, "é" * 120),
        (17, "one"),
        (18, "one"),
        (19, "One  TWO"),
        (20, "日本語のテキスト " * 12),
        (21, "x" * 300),
        (22, "y " + "x" * 300),
    ]


@pytest.fixture(scope="module")
def edges(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{c}` string" for c in EXTRA
    )
    langs = ["en", "de", None]
    rows = [
        (d, t, langs[i % 3], None if i % 5 == 0 else f"s{i % 2}", None if t is None else len(t), *["z"] * len(EXTRA))
        for i, (d, t) in enumerate(edge_rows())
    ]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def nothing(edges):
    return edges.where("false")
