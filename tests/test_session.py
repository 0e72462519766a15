"""The checkpoint folder rule: read it from the session, set our own only
where it is unset. Runs in a separate process, since a JVM's settings are
fixed once it starts."""

import os
import subprocess
import sys
import tempfile
import textwrap

from conftest import ROOT, SF_SMALL

SCRIPT = textwrap.dedent(f"""
    import sys
    sys.path.insert(0, {ROOT!r})
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[2]")
             .config("spark.ui.enabled", "false").getOrCreate())
    assert spark.conf.get("spark.checkpoint.dir", None) is None
    assert spark.sparkContext.getCheckpointDir() is None
    import __spark_entry__ as E
    n = E.entry(spark).count()
    q3 = E.queries()["q3_ties_all"](spark, {SF_SMALL!r}).count()
    print("OK", n, q3, spark.sparkContext.getCheckpointDir())
""")


def test_own_checkpoint_folder_only_when_unset():
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="forumlens-noconf-"))
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("OK")][0]
    _, n, q3, folder = line.split()
    assert int(n) > 0 and int(q3) > 0
    assert "forumlens-ckpt-" in folder


def test_cluster_without_shared_folder_raises():
    from types import SimpleNamespace

    import pytest

    from forumlens.session import ensure_checkpoint_dir, is_local

    assert is_local("local") and is_local("local[8]") and not is_local("local-cluster[2,1,512]")
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    conf = SimpleNamespace(get=lambda key, default=None: default)
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))
