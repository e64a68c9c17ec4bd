from types import SimpleNamespace

import pytest

from tidemark.session import scratch_dir, scratch_root, stage, staged_bytes


def session(master, root=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: root or default),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_the_named_folder_is_used():
    assert scratch_root(session("spark://host:7077", "/shared/scratch")) == "/shared/scratch"
    assert scratch_dir(session("local[2]", "/shared/scratch/"), "x").startswith("/shared/scratch/x-")


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session("spark://host:7077"))
    local = session("local[2]")
    assert scratch_root(local) == scratch_root(local)


def test_stage(spark):
    staged = stage(spark.range(10))
    assert staged.count() == 10 and staged_bytes(staged) > 0
    assert staged_bytes(stage(spark.range(0))) == 0
