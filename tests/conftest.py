import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.exportfiles import write_samples  # noqa: E402

# invented exports of the supervision tool, written anew for each session
SAMPLES = write_samples(tempfile.mkdtemp(prefix="trackyard-samples-"))


@pytest.fixture(scope="session")
def spark():
    from trackyard.session import build_session

    s = build_session("local[4]", 4, app_name="trackyard-tests",
                      extra={"spark.driver.memory": "4g"})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="trackyard-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def workdir(tmp_path):
    return str(tmp_path)
