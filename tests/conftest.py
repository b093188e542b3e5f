import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadence.session import build_session, ensure_checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("local[*]", app="cadence-tests", shuffle_partitions=8,
                      extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    ensure_checkpoint_dir(s, str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, tmp_path):
    """A fresh folder for one test's tables."""
    return str(tmp_path)
