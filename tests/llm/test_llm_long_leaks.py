"""Long documents full of benchmark passages (op2_decontaminate, pipeline): what a task holds at once."""

import os
import subprocess
import sys

from aerolytics.llm import decontaminate
from tests.conftest import ROOT

SMALL_HEAP = """
import sys
from pyspark.sql import SparkSession
from aerolytics.llm import decontaminate
spark = (SparkSession.builder.master("local[1]").config("spark.driver.memory", "512m").config("spark.ui.enabled", "false")
         .config("spark.local.dir", sys.argv[1]).config("spark.checkpoint.dir", sys.argv[1] + "/kept")
         .config("spark.sql.shuffle.partitions", "1").getOrCreate())
item = " ".join(f"w{i}" for i in range(60))
docs = spark.createDataFrame([(1, " ".join([item] * 110)), (2, "no " * 50), (3, None)], "doc_id long, text string")
bench = spark.createDataFrame([(7, item)], "item_id long, text string")
print([tuple(r) for r in decontaminate.find_leaks(docs, bench).collect()])
"""


def test_a_long_document_full_of_passages_fits_a_small_heap(tmp_path):
    """6,600 words, nearly each the begin of a shingle of the item: rows with all words would take 1 GB."""
    run = subprocess.run([sys.executable, "-c", SMALL_HEAP, str(tmp_path)], capture_output=True, text=True, timeout=240,
                         env=os.environ | {"PYTHONPATH": ROOT, "PYSPARK_PYTHON": sys.executable})
    assert run.returncode == 0, run.stderr[-2000:]
    assert run.stdout.split("\n")[-2] == "[(1, 7, 1.0, 0, 60, 0)]"


def test_results_do_not_depend_on_the_parts_of_a_text(spark, monkeypatch):
    def text(*runs):
        return " ".join(f"{k}{i}" for k, a, b in runs for i in range(a, b))

    bench = spark.createDataFrame([(1, text(("a", 0, 30))), (2, text(("a", 10, 30), ("b", 0, 9))), (3, text(("c", 0, 5))),
                                   (4, text(("d", 0, 9)) + " " + text(("d", 0, 9))), (5, "too short")], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, text(("x", 0, 40), ("a", 0, 30), ("x", 0, 9))), (2, text(("a", 2, 30), ("b", 0, 9))),
        (3, text(("c", 0, 5))), (4, text(("x", 0, 11), ("c", 0, 5), ("d", 0, 9), ("d", 0, 9), ("a", 1, 29))),
        (None, text(("y", 0, 100), ("a", 0, 30))), (None, text(("a", 0, 28))), (7, text(("c", 0, 4))), (8, None), (9, ""),
        (9, text(("z", 0, 3), ("a", 0, 30), ("a", 0, 30)))], "doc_id long, text string")

    def leaks():
        return sorted((tuple(r) for r in decontaminate.find_leaks(docs, bench).collect()), key=str)

    whole = leaks()
    assert {r[:2] for r in whole} >= {(1, 1), (2, 2), (3, 3), (4, 1), (4, 3), (4, 4), (None, 1), (9, 1)}
    for size in (1, 7):
        monkeypatch.setattr(decontaminate, "CHUNK", size)
        assert leaks() == whole
