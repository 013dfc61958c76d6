import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from farebox.session import local_session

    ckpt = tempfile.mkdtemp(prefix="farebox-test-ckpt-")
    session = local_session("farebox-tests", shuffle_partitions=8, extra={
        "spark.checkpoint.dir": ckpt,
        "spark.sql.maxMetadataStringLength": "10000",  # plan text with whole file locations
    })
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    from farebox.session import scratch_path

    return lambda name: scratch_path(spark, name)


def explain_text(df, mode: str = "formatted") -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
