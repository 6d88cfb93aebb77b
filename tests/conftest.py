from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from docroll.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Tests set their own shared folder (on a cluster it comes from the session).
    ckpt = tempfile.mkdtemp(prefix="docroll-test-ckpt-")
    session = build_session(
        "local[*]",
        app_name="docroll-tests",
        shuffle_partitions=8,
        conf={"spark.checkpoint.dir": ckpt},
    )
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir(spark):
    from docroll.session import scratch_path

    return scratch_path(spark, "test")


def rows(df, *cols):
    """Sorted list of tuples of the chosen columns (all when none given)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
