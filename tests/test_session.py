"""Scratch tables and the independence of the entry module."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from conftest import rows

from tabulon.session import materialize, scratch_tables

ROOT = Path(__file__).resolve().parent.parent


def test_a_block_leaves_what_is_kept(spark):
    with scratch_tables(spark) as outer:
        with scratch_tables(spark) as inner:
            first, second = materialize(spark.range(3)), materialize(spark.range(4))
            inner.keep(second)
        assert not os.path.exists(first._scratch_path) and second.count() == 4
        third = materialize(spark.range(5))
        outer.keep(third)
    assert not os.path.exists(second._scratch_path) and rows(third) == [(k,) for k in range(5)]


def test_a_failed_block_leaves_nothing(spark):
    with pytest.raises(RuntimeError), scratch_tables(spark) as scratch:
        kept = materialize(spark.range(3))
        scratch.keep(kept)
        raise RuntimeError
    assert not os.path.exists(kept._scratch_path)


def test_dropped_early_and_without_a_block(spark):
    with scratch_tables(spark) as scratch:
        gone = materialize(spark.range(3))
        scratch.drop(gone)
        assert not os.path.exists(gone._scratch_path)
    assert materialize(spark.range(3).repartition(2)).count() == 3
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_the_rest_stands_without_the_training_data_part(tmp_path):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    for name in ("tabulon", "oracle", "tools"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'kde' in q and set(s) <= set(q); assert 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)}, timeout=120)
