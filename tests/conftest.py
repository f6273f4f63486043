import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clusterloom.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    s = local_session("8")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def frame(spark):
    def make(x, ids=None, **columns):
        ids = list(range(len(x))) if ids is None else ids
        extra = list(columns)
        rows = [(int(i), [float(v) for v in r], *[columns[c][j] for c in extra]) for j, (i, r) in enumerate(zip(ids, x))]
        ddl = ", ".join(f"{c} {'string' if isinstance(columns[c][0], str) else 'int'}" for c in extra)
        return spark.createDataFrame(rows, "id bigint, features array<double>" + (f", {ddl}" if ddl else ""))

    return make


@pytest.fixture
def blobs():
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(c, 0.3, size=(25, 3)) for c in ((0, 0, 0), (3, 0, 1), (0, 4, 2))])
    return x, np.repeat([0, 1, 2], 25)
