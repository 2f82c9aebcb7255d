from __future__ import annotations

import random
from collections import Counter

import brute
import pytest
from conftest import SENTENCE, edge_rows

import corpus_pipeline as pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    """The stages, each against a plain version of what it is to do."""
    rows = edge_rows()
    rows += [(100 + i, f"{SENTENCE} number {i} of many more words that differ " + f"q{i} " * (i + 30)) for i in range(40)]
    rows += [(200 + i, rows[-1 - i][1]) for i in range(10)]  # exact copies
    docs = spark.createDataFrame(
        [(d, t, "en", f"s{i % 4}", None if t is None else len(t)) for i, (d, t) in enumerate(rows)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    left = rows
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == COLUMNS
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        found = [(r[0], r[1]) for r in docs.collect()]
        if name == "language_id":
            left = [(d, t) for d, t in left if any(c.isalpha() for c in t or "")]
        elif name == "exact_dedup":
            best = {}
            for d, t in left:
                best[t] = max(best.get(t, -1), -1 if d is None else d)
            left = [(None if d == -1 else d, t) for t, d in best.items()]
        elif name == "simhash_dedup":
            near = brute.components(left)
            left = [x for x, (d, _, c) in zip(left, near, strict=True) if d == c]
        elif name == "mixing":
            assert {x for x in found} <= {x for x in left}
            left = found
        else:
            packed = Counter(r.doc_id for r in docs.collect() if r.piece == 0)
            assert packed == Counter(d for d, _ in left)
            break
        assert sorted(map(str, found)) == sorted(map(str, left)), name


@pytest.mark.parametrize("n", [1, 4, 8])
def test_documents_in_no_language_go(spark, tmp_path, n):
    """Whatever the number of languages there are to choose from."""
    r = random.Random(n)
    vocabulary = []
    for _ in range(n):
        letters = r.sample("abcdefghijklmnopqrstuvwxyz", 14)
        vocabulary.append(["".join(r.choices(letters, k=r.randint(3, 8))) for _ in range(150)])
    rows = [
        (i, " ".join(r.choices(vocabulary[i % n], k=80)), f"l{i % n}", "s", 0)
        for i in range(100 * n)
    ]
    mash = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(3, 9))) for _ in range(240)]
    none = ["в начале было слово " * 9, "这是一个测试文本 " * 9, "ภาษาไทยง่ายมาก " * 9, " ".join(mash[:120]), " ".join(mash[120:])]
    none += ["one word of " + "только кириллица " * 9, "1 2 3", ""]
    mixed = " ".join(vocabulary[0][:40]) + " слово " + " ".join(vocabulary[-1][:40])
    rows += [(10_000 + i, t, None, "s", 0) for i, t in enumerate(none)] + [(20_000, mixed, None, "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {x.doc_id for x in pipeline.identify_language(spark, docs, str(tmp_path)).collect()}
    assert kept == {*range(100 * n), 20_000}


def test_empty_documents(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0


def test_run_on_a_table(spark):
    out = pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns[:2] == ["doc_id", "piece"] and out.count() > 100


@pytest.mark.parametrize("labels", [0, 2, 20])
def test_few_labels_lose_no_document(spark, tmp_path, labels):
    """What was learned from a handful of texts rejects none."""
    sentences = ["The committee will publish its report in spring.", "Nobody had expected the river to rise so fast.",
                 "Fresh bread is sold at the corner until noon.", "She wrote down every word of his long speech.",
                 "Old maps often show islands that never existed."]
    r = random.Random(labels)
    rows = [(i, " ".join(r.sample(sentences, 2 if i < labels else 1)), "en" if i < labels else None, "s", 0) for i in range(40)]
    rows += [(100, "1 2 3", None, "s", 0), (101, None, "en", "s", 0), (102, "́̂", None, "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {x.doc_id for x in pipeline.identify_language(spark, docs, str(tmp_path)).collect()}
    assert kept == set(range(40))
