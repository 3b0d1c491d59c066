import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from setsim.session import get_spark  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app_name="setsim-tests", shuffle_partitions=4)
    # Tests set their own checkpoint folder only when the session names none.
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="setsim-test-ckpt-"))
    yield s
    s.stop()


def fps_frame(spark, rows):
    """A fingerprint table from literal ``(id, [bits])`` rows."""
    return spark.createDataFrame(rows, "chembl_id string, fingerprint_on_bits array<bigint>")


def scored_frame(spark, rows):
    return spark.createDataFrame(rows, "source_chembl_id string, target_chembl_id string, similarity_score double")
