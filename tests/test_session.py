"""The shared scratch folder: read from the session, set only on a local master."""

import types

import pytest

from tripkpi import session


def fake(master, configured=None):
    state = {"dir": None}
    sc = types.SimpleNamespace(master=master, getCheckpointDir=lambda: state["dir"],
                               setCheckpointDir=lambda d: state.update(dir=d))
    return types.SimpleNamespace(sparkContext=sc, conf=types.SimpleNamespace(get=lambda k, d=None: configured or d))


def test_unset_folder_on_a_cluster_is_an_error():
    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(fake(master))


def test_local_master_gets_a_folder_and_a_set_one_is_kept():
    assert session.ensure_checkpoint_dir(fake("local[4]"))
    assert session.ensure_checkpoint_dir(fake("yarn", "hdfs:///shared/")) == "hdfs:///shared"
