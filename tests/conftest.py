import json
import os
import tempfile
import uuid

import pytest

from tidesync.session import build_session

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8, app="tidesync-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="tidesync-tests-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    d = os.path.join(spark.conf.get("spark.checkpoint.dir"), "t-" + uuid.uuid4().hex[:10])
    os.makedirs(d)
    return d


def write_pages(folder, pages, name="pages.json"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for p in pages:
            f.write(json.dumps(p) + "\n")
    return folder
