import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from clickforge.session import build_session
    ckpt = tempfile.mkdtemp(prefix="clickforge-test-ckpt-")
    # short queries: the JVM's quick compiler only
    s = build_session("local[4]", 4, app_name="clickforge-tests",
                      extra={"spark.checkpoint.dir": ckpt,
                             "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
