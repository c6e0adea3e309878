from types import SimpleNamespace

import pytest

from tidemill.session import cut_lineage, shared_folder, work_path


def session(folder, master="local[2]"):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: folder),
                           sparkContext=SimpleNamespace(master=master, applicationId="app-1"))


def test_shared_folder_comes_from_the_session():
    assert shared_folder(session("hdfs://x/ckpt/", "yarn")) == "hdfs://x/ckpt"
    assert work_path(session("/shared"), "a").startswith("/shared/a-")


def test_local_folder_only_for_a_local_master():
    local = shared_folder(session(None))
    assert local == shared_folder(session(None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session(None, "yarn"))


def test_checkpoint_cuts_the_plan(spark):
    df = cut_lineage(spark.range(10).selectExpr("id * 2 AS x"))
    assert df.count() == 10 and "Range" not in df._jdf.queryExecution().executedPlan().toString()
