"""Session helpers and durations."""

from types import SimpleNamespace

import pytest

from lakeride.functions.timecols import seconds
from lakeride.session import checkpoint_root


def fake(master, conf=None, folder=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: context.folder, folder=folder)
    context.setCheckpointDir = lambda path: setattr(context, "folder", path)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf or default), sparkContext=context)


def test_checkpoint_folder_is_the_configured_one():
    assert checkpoint_root(fake("yarn", "hdfs://c/ckpt/")) == "hdfs://c/ckpt"
    assert checkpoint_root(fake("yarn", None, "hdfs://c/own")) == "hdfs://c/own"


def test_no_machine_local_folder_on_a_cluster():
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            checkpoint_root(fake(master))
    s = fake("local[4]")
    assert checkpoint_root(s) == checkpoint_root(s)


@pytest.mark.parametrize("text, want", [("90s", 90), ("1m30s", 90), ("1.5h", 5400), ("2d", 172800), ("1w", 604800), (15, 15), ("2000ms", 2), ("1h5m", 3900)])
def test_durations(text, want):
    assert seconds(text) == want


@pytest.mark.parametrize("text", ["500ms", "1.5s", "", "5 parsecs", "m5", 0.5, "-5m"])
def test_durations_that_cannot_be_whole_seconds_are_errors(text):
    with pytest.raises(ValueError):
        seconds(text)
