import os
import subprocess
import sys

import pytest

from oreline import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


class FakeConf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class FakeContext:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    def __init__(self, master, conf=None, folder=None):
        self.sparkContext, self.conf = FakeContext(master, folder), FakeConf(conf or {})


def test_the_configured_folder_is_used():
    s = FakeSession("yarn", {"spark.checkpoint.dir": "hdfs:///shared"})
    assert session.shared_dir(s) == "hdfs:///shared"
    assert s.sparkContext.folder == "hdfs:///shared"
    assert session.scratch_path(s, "x").startswith("hdfs:///shared/oreline/x-")


def test_a_folder_already_set_is_kept():
    s = FakeSession("yarn", {"spark.checkpoint.dir": "hdfs:///shared"}, "hdfs:///shared/app-1")
    assert session.shared_dir(s) == "hdfs:///shared" and s.sparkContext.folder == "hdfs:///shared/app-1"


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        session.shared_dir(FakeSession("spark://host:7077"))


def test_lineage_is_cut(spark):
    df = session.cut_lineage(spark.range(100).repartition(3))
    assert df.count() == 100
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_kernels_need_no_package_on_the_executors(tmp_path):
    """Workers start elsewhere and cannot import the package."""
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
import numpy as np
from oreline.session import local_session
from oreline.operators import cluster, lowrank
spark = local_session(2, 2, "1g")
df = spark.createDataFrame([(i, "s", [float(i), 1.0]) for i in range(8)], "id int, series string, v array<double>")
assert cluster.assign(df, np.zeros((1, 2, 2))).count() == 8
assert lowrank.eigen(lowrank.covariance(df, vec="v")).count() == 2
print("done")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("done"), out.stderr[-2000:]
