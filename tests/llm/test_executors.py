"""Executors need the libraries, not this package."""

from __future__ import annotations

import os
import subprocess
import sys

SCRIPT = """
import sys, random, tempfile
from pyspark.sql import SparkSession
sys.path.insert(0, REPO)  # the driver's alone
from ferryline.llm import queries
import corpus_pipeline
work = tempfile.mkdtemp()
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", work + "/ck").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
def without(batches):
    for _ in batches:
        pass
    try:
        import ferryline
        raise SystemExit("a worker can import the package")
    except ModuleNotFoundError:
        yield from ()
assert spark.range(4).mapInArrow(without, "id long").count() == 0
r = random.Random(1)
docs = [(i, " ".join(r.choices("alpha beta gamma delta rho".split(), k=40)), ["en", "fr"][i % 2], "s", 0) for i in range(24)]
docs += [(100, docs[3][1], "en", "s", 0), (101, None, None, None, None)]
spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(work + "/documents.parquet")
spark.createDataFrame([(1, "u", "<html><body><article><p>Some words of a page.</p></article></body></html>")],
                      "page_id long, url string, html string").write.parquet(work + "/pages.parquet")
spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "ho")],
                      "conv_id long, turn int, role string, text string").write.parquet(work + "/conversations.parquet")
spark.createDataFrame([(i, [r.random() for _ in range(64)]) for i in range(30)],
                      "vec_id long, embedding array<float>").write.parquet(work + "/embeddings.parquet")
for name, query in {**queries.QUERIES, "pipeline": corpus_pipeline.run}.items():
    assert query(spark, work).count() > 0, name
    print("ran", name, flush=True)
"""


def test_every_query_runs_where_workers_lack_the_package(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = tmp_path / "script.py"
    script.write_text(f"REPO = {repo!r}\n{SCRIPT}")
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900, check=False
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("ran op") == 13 and "ran pipeline" in done.stdout
