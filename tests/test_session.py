"""Session settings and the scratch folder."""

import ast
import inspect

import pytest

from shelfline import session as S


class FakeContext:
    def __init__(self, master):
        self.master = master

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return None


class FakeSession:
    def __init__(self, master):
        self.sparkContext, self.conf = FakeContext(master), {}


@pytest.mark.parametrize("master", ["yarn", "k8s://host", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError):
        S.scratch_dir(FakeSession(master))


def test_local_masters():
    assert S.is_local("local") and S.is_local("local[4]") and S.is_local("local[*]") and not S.is_local("local-cluster[2,1,1024]")


def test_the_session_pins_nothing_unasked():
    """Master, shuffle partitions and memory are set from arguments only, and these default to none."""
    sig = inspect.signature(S.get_session).parameters
    assert all(sig[n].default is None for n in ("master", "shuffle_partitions", "driver_memory"))
    strings = {n.value for n in ast.walk(ast.parse(inspect.getsource(S.get_session))) if isinstance(n, ast.Constant)}
    assert "BENCH_CPUS" not in strings


def test_scratch_is_the_named_folder(spark):
    assert S.scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
