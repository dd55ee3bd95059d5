from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # spark.checkpoint.dir comes from the environment's defaults when set;
    # build_session only creates one when it is unset.
    from crownlake.session import build_session

    scratch = tempfile.mkdtemp(prefix="crownlake-tests-")
    s = build_session(
        "local[4]",
        app_name="crownlake-tests",
        shuffle_partitions=4,
        extra={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.driver.memory": "4g",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Sorted plain tuples of ``df`` (optionally selected columns)."""
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=repr)
