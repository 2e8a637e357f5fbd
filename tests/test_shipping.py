"""Code for Python workers must not need the package on the executors."""

from __future__ import annotations

import subprocess
import sys
from datetime import timedelta

import pytest
from pyspark import cloudpickle

from tickloom.operators.logistic import _solve, fit_array
from tickloom.streaming.alerts import MoveTracker


@pytest.mark.parametrize("thing", [MoveTracker(timedelta(minutes=5)), fit_array, _solve(["k"], 3)], ids=["tracker", "fit", "solve"])
def test_worker_code_travels_by_value(thing, tmp_path):
    (tmp_path / "code").write_bytes(cloudpickle.dumps(thing))
    load = "import pickle, sys; pickle.load(open('code', 'rb')); assert 'tickloom' not in sys.modules"
    subprocess.run([sys.executable, "-c", load], cwd=tmp_path, check=True)


def test_cluster_without_shared_folder_is_refused(monkeypatch):
    from tickloom import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default=None):
            return default

    class Spark:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Spark())
