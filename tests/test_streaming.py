import os

from conftest import SF0001
from notifyq.functions.protect import generate_key
from notifyq.plans.runner import Tables
from notifyq.streaming.incremental import start_incremental_runs
from test_runner import _write_landing


def test_incremental_runs_each_file_once(spark, workdir):
    landing = _write_landing(spark, workdir)
    root = os.path.join(workdir, "tables")
    ckpt = os.path.join(workdir, "stream-ckpt")
    key = generate_key()
    q = start_incremental_runs(spark, landing, root, key, checkpoint_location=ckpt)
    q.awaitTermination(300)
    t = Tables(root)
    audit = spark.read.parquet(t.load_audit).orderBy("run_id").collect()
    assert len(audit) == 2
    assert sum(r.rows_inserted for r in audit) == spark.read.parquet(t.destination).count()
    # A second start finds no new file and writes nothing.
    q2 = start_incremental_runs(spark, landing, root, key, checkpoint_location=ckpt)
    q2.awaitTermination(300)
    assert spark.read.parquet(t.load_audit).count() == 2
