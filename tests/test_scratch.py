import subprocess
import sys
from pathlib import Path

import pytest

from ledgerwake.sources import scratch


class Session:
    """Just enough of a session to ask for settings."""

    def __init__(self, **settings):
        self.settings = {key.replace("__", "."): value for key, value in settings.items()}
        self.conf = self
        self.sparkContext = self
        self.applicationId = "app"

    def get(self, key, default):
        return self.settings.get(key, default)


def test_the_clusters_folder_is_used():
    session = Session(spark__checkpoint__dir="s3a://shared/cp/", spark__master="yarn")
    first, second = (scratch.scratch_dir(session, "x") for _ in range(2))
    assert first.startswith("s3a://shared/cp/x-") and first != second


def test_a_cluster_without_the_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session(spark__master="yarn"))


def test_local_mode_makes_its_own_folder_once():
    session = Session(spark__master="local[2]")
    assert scratch.scratch_root(session) == scratch.scratch_root(session)


def test_what_was_given_is_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "_given", {})
    monkeypatch.setattr(scratch, "scratch_root", lambda session: str(tmp_path))
    (tmp_path / "mine").mkdir()
    frame = scratch.staged(spark.range(3), "x")
    assert frame.count() == 3 and len(list(tmp_path.iterdir())) == 2
    scratch.clear(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["mine"]
    scratch.clear(spark)


def test_nothing_is_left_when_a_process_ends(tmp_path):
    script = """
from pyspark.sql import SparkSession
from ledgerwake.sources import scratch
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config(
    "spark.checkpoint.dir", FOLDER).getOrCreate()
assert scratch.staged(spark.range(3), "x").count() == 3
import os
assert [x for x in os.listdir(FOLDER) if x.startswith("x-")]
"""
    script = script.replace("FOLDER", repr(str(tmp_path)))
    subprocess.run([sys.executable, "-c", script], check=True, capture_output=True,
                   cwd=Path(__file__).parent.parent, timeout=120)
    # Spark makes a folder for its own checkpoints.
    assert list(tmp_path.glob("x-*")) == []
