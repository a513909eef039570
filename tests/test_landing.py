"""Landing files: the newest by its name, and the stream against the batch on the same files."""

import os

import pytest
from pyspark.sql import functions as F

from notifyq import schema as S
from notifyq.functions.protect import generate_key
from notifyq.plans import runner
from notifyq.sources.files import exact_path, newest_file, read_newest_csv, read_raw_csv
from notifyq.streaming.incremental import start_incremental_runs
from test_operational import write


def test_only_the_newest_file_is_read(spark, workdir):
    for k in (1, 3, 2):
        write(f"{workdir}/in/n_2025010{k}.csv", [{"notification_id": f"N{k}"}])
    write(f"{workdir}/in/notes.txt", [{}])
    rows = read_newest_csv(spark, f"{workdir}/in")
    assert [os.path.basename(f) for f in rows.inputFiles()] == ["n_20250103.csv"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan and "n_20250103.csv" in plan
    assert [(r.notification_id, r.batch_id) for r in rows.collect()] == [("N3", "n_20250103")]
    assert newest_file(spark, f"{workdir}/in", "n_2025010[12].csv").endswith("n_20250102.csv")


def test_newest_of_equal_names_empty_folders_and_odd_names(spark, workdir):
    for folder in ("a", "b"):
        write(f"{workdir}/{folder}/n 1.csv", [{"notification_id": folder}])
    rows = read_newest_csv(spark, [f"{workdir}/b", f"{workdir}/a"]).collect()
    assert [r.notification_id for r in rows] == ["b"]
    os.makedirs(f"{workdir}/empty")
    with pytest.raises(FileNotFoundError):
        newest_file(spark, f"{workdir}/empty")
    for name in ("z{1,2}.csv", "z[ab].csv", "z1.csv"):
        write(f"{workdir}/odd/{name}", [{"notification_id": name}])
    assert newest_file(spark, f"{workdir}/odd").endswith("z{1,2}.csv")
    assert [r.notification_id for r in read_newest_csv(spark, f"{workdir}/odd").collect()] == ["z{1,2}.csv"]
    assert exact_path("/x/a*b") == "/x/a\\*b"


def tables(spark, root):
    """What a run leaves, without ids and clocks of runs."""
    dest = runner.destination_rows(spark, root).drop("loaded_at", "run_id", "load_id", "user_id_enc", "source_user_id_enc", S.ROW_ORD)
    rej = runner.rejected_rows(spark, root).select("notification_id", "reject_reason", "stage", S.BATCH_ID, F.col("payload").cast("string"))
    raw = spark.read.parquet(f"{root}/raw")
    files = spark.read.parquet(f"{root}/manifest").select("path", "source_file", "sha256", "bytes", "rows", "lines")
    return [sorted(map(tuple, x.collect()), key=str) for x in (dest, rej, raw.select(*S.RAW_COLUMNS, S.BATCH_ID, f"{S.ROW_ORD}.file"), files)]


def test_stream_and_batch_give_the_same_tables(spark, workdir):
    bad = {"device": "TOASTER"}
    write(f"{workdir}/in/x/n1.csv", [{"event_id": 's "q" x', "notification_id": "N1"}, {**bad, "notification_id": "N2", "post_id": 'a, "b"'}])
    write(f"{workdir}/in/y/n1.csv", [{"notification_id": "N3", "event_id": " NA "}, {**bad, "notification_id": "N2"}])
    write(f"{workdir}/in/y/n2.csv", [])
    with open(f"{workdir}/in/x/n1.csv", "a") as f:
        f.write('N9,"",LIKE' + "," * (len(S.RAW_COLUMNS) - 3) + "\n")
    key, both, ckpt = generate_key(), {}, f"{workdir}/ckpt"
    start_incremental_runs(spark, f"{workdir}/in/*", f"{workdir}/stream", key, ckpt, S.DEFAULT_AS_OF, files_per_trigger=10).awaitTermination(300)
    raw = runner.stage_ingest(spark, [f"{workdir}/in/x", f"{workdir}/in/y"], f"{workdir}/batch", "b1")
    runner.run_batch(spark, raw, f"{workdir}/batch", key, run_id="b1", as_of=S.DEFAULT_AS_OF)
    for how in ("stream", "batch"):
        both[how] = tables(spark, f"{workdir}/{how}")
    assert both["stream"] == both["batch"]
    dest, rej, raw, files = both["stream"]
    assert ('s "q" x' in str(raw)) and len(raw) == 5 and len(files) == 3
    assert {r[0].rsplit("/", 2)[-2] for r in files} == {"x", "y"}

    columns = list(S.RAW_COLUMNS)
    i, j = columns.index("user_id"), columns.index("source_user_id")
    columns[i], columns[j] = columns[j], columns[i]
    write(f"{workdir}/in/x/n3.csv", [{}], columns)
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, f"{workdir}/in/x").collect()
    with pytest.raises(Exception, match="(?i)header"):
        start_incremental_runs(spark, f"{workdir}/in/*", f"{workdir}/stream", key, ckpt, S.DEFAULT_AS_OF).awaitTermination(300)
    assert tables(spark, f"{workdir}/stream")[0] == dest


def test_content_landed_twice_is_recognised(spark, workdir):
    rows = [{"notification_id": f"N{k}"} for k in range(40)]
    write(f"{workdir}/a/n1.csv", rows)
    write(f"{workdir}/b/copy.csv", rows[::-1])  # the same lines, moved
    write(f"{workdir}/b/other.csv", [*rows[:-1], {"notification_id": "M9"}])
    root = f"{workdir}/t"
    for run, folder in (("r1", "a"), ("r2", "b"), ("r2", "b"), ("r3", "a")):
        runner.stage_ingest(spark, f"{workdir}/{folder}", root, run)
    got = {(r.run_id, r.source_file): r.landed_before for r in spark.read.parquet(f"{root}/manifest").collect()}
    assert got == {("r1", "n1.csv"): False, ("r2", "copy.csv"): True, ("r2", "other.csv"): False, ("r3", "n1.csv"): True}


def test_line_digest_is_that_of_the_lines_for_any_split(spark, workdir):
    import hashlib

    from notifyq.sources.manifest import line_digests

    write(f"{workdir}/in/n.csv", [{"notification_id": f"N{k}", "event_id": "É" * (k % 7)} for k in range(500)])
    with open(f"{workdir}/in/n.csv", "rb") as f:
        lines = f.read().replace(b"\r\n", b"\n").split(b"\n")[:-1]
    parts = [0] * 8
    for line in lines:
        h = hashlib.sha256(line).hexdigest()
        parts = [(p + int(h[8 * k : 8 * k + 8], 16)) % (1 << 32) for k, p in enumerate(parts)]
    want = (len(lines), "".join(f"{p:08x}" for p in parts))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (old, "4096"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            assert [(r.lines, r.lines_digest) for r in line_digests(spark, f"{workdir}/in").collect()] == [want]
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_path_that_only_spark_opens(spark, workdir):
    import hashlib

    from notifyq.sources.manifest import file_hashes, file_manifest

    write(f"{workdir}/in/n.csv", [{}, {"notification_id": "N2"}])
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.landing.link./in", f"file://{workdir}/in")
    with open(f"{workdir}/in/n.csv", "rb") as f:
        want = hashlib.sha256(f.read()).hexdigest()
    r = file_manifest(spark, "viewfs://landing/in").first()
    assert (r.source_file, r.sha256, r.rows, r.lines) == ("n.csv", want, 2, 3)
    assert file_hashes(spark, "viewfs://landing/in", whole=1).first().sha256 is None  # too large to hold, no other reader
    assert file_hashes(spark, f"{workdir}/in", whole=1).first().sha256 == want
    assert newest_file(spark, "viewfs://landing/in").endswith("/in/n.csv")
