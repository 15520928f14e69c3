"""The folder that executors share, as a cluster names it."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrameWriter

from tests.conftest import SF_SMALL
from tidemark import session
from tidemark.llm.common import shared_dir
from tidemark.plans.queries import validate_accepted


@pytest.fixture()
def on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://driver:7077")
    base = spark.sparkContext.getCheckpointDir()
    monkeypatch.setattr(spark.sparkContext, "getConf", lambda: {"spark.checkpoint.dir": base})
    monkeypatch.setattr(session, "_SHARED", set(), raising=False)


def test_a_shared_file_folder_is_used_on_a_cluster(spark, on_a_cluster):
    base = spark.sparkContext.getCheckpointDir()
    assert base.startswith("file:")
    assert session.work_folder(spark, "x").startswith(f"{base}/tidemark/x-")
    assert shared_dir(spark).startswith("file:")
    assert validate_accepted(spark, SF_SMALL).count() > 0


def test_a_file_folder_that_is_probed_once_leaves_nothing(spark, on_a_cluster, monkeypatch):
    base = spark.sparkContext.getCheckpointDir()
    session.work_folder(spark, "x")
    assert not [p for p, _ in session.list_folder(spark, f"{base}/tidemark") if "/probe-" in p]
    monkeypatch.setattr(DataFrameWriter, "parquet", None)  # a second probe would fail
    session.work_folder(spark, "x")


def test_a_folder_of_each_machines_own_is_refused(spark, on_a_cluster, monkeypatch):
    def lost(writer, path):  # tasks write to disks that the driver does not see
        spark.range(0).write.format("parquet").save(path)

    monkeypatch.setattr(DataFrameWriter, "parquet", lost)
    for folder in (lambda: session.work_folder(spark, "x"), lambda: shared_dir(spark)):
        with pytest.raises(RuntimeError, match="all executors share"):
            folder()
