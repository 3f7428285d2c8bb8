"""Executors without the repository: what tasks need travels with the job."""

import os
import pathlib
import subprocess
import sys
import textwrap

ROOT = str(pathlib.Path(__file__).parents[2])


def test_workers_need_no_copy_of_the_package(tmp_path):
    run = f"""
        import sys
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
        def importable(rows):
            try:
                import ratewise
                yield True
            except ImportError:
                yield False
        sys.path.insert(0, {ROOT!r})
        from ratewise.llm import packing, suffix_dedup
        assert not any(spark.sparkContext.parallelize([1], 1).mapPartitions(importable).collect())
        text = "the quick brown fox jumps over the lazy dog and goes on and on " * 9
        docs = spark.createDataFrame([(1, text), (2, "own words, " + text), (3, None)], "doc_id long, text string")
        assert packing.token_pieces(docs, special=True).count() == 3
        assert {{r["doc_id"]: r["n_removed"] > 0 for r in suffix_dedup.remove_repeats(docs).collect()}} == {{1: True, 2: True, 3: False}}
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(run)], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
