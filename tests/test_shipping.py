import os
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from gridloom.sources import scratch

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the driver's tables aren't here")
def test_workers_find_the_package_from_any_folder(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__ as e
assert e.queries()["distance_edt"](s, "/root/testdata/sf0.001").count() == 16384
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=300)


def session(master, folder=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: folder or d), sparkContext=SimpleNamespace(master=master))


def test_only_a_local_master_gets_a_folder_of_its_own():
    assert scratch.root(session("spark://host:7077", "hdfs://a/b/")) == "hdfs://a/b"
    assert scratch.root(session("local[4]")).startswith("file://")
    for master in ("local-cluster[2,1,1024]", "yarn", "k8s://x"):
        with pytest.raises(ValueError, match="checkpoint"):
            scratch.root(session(master))
