"""What the ingest queries leave on disk."""

import os

import pytest

from trackyard.plans import bronze
from trackyard.plans import ingest_queries as Q

SF = os.environ.get("TRACKYARD_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test tables not available")


def _shuffled(spark):
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks().mkString(" ").split()
    return {b for b in blocks if b.startswith("shuffle_")}


def _scratch(spark):
    return set(os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:")))


def test_shuffle_files_go_with_their_jobs(spark, workdir):
    before = _shuffled(spark)
    path = Q.handover_files(spark, SF)
    stats = bronze.ingest_folder(spark, Q._folders(spark, path), f"{workdir}/bronze", "b", tables={path: Q.HO})
    assert stats.files_success == 9
    assert not _shuffled(spark) - before


def test_loaded_exports_are_let_go(spark):
    before = _scratch(spark)
    assert Q.q_ingest_log(spark, SF).count() == 6
    assert {n.split("-")[0] for n in _scratch(spark) - before} == {"bronze"}
