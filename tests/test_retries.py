"""A task that fails once is retried and the load is still exact.

Local mode retries tasks only with ``local[N,F]``, so the scenario runs in
its own process. The failure is injected with a test-only Python UDF that
raises on the first attempt of partition 0, during the upsert's write.
"""

import os
import subprocess
import sys
import textwrap

SCRIPT = textwrap.dedent("""
    import datetime as dt, sys
    sys.path.insert(0, sys.argv[1])
    from pyspark import TaskContext
    from pyspark.sql import functions as F, types as T
    from lakeloom.session import build_session
    from lakeloom.sinks import upsert_table

    spark = build_session("local[2,3]", 4, extra={"spark.checkpoint.dir": sys.argv[2]})
    spark.sparkContext.setLogLevel("OFF")

    marker = sys.argv[2] + "-failed-once"    # captured here: workers have their own argv

    @F.udf(T.StringType())
    def flaky(v):
        ctx = TaskContext.get()
        if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
            open(marker, "w").close()                # proof the failure happened
            raise RuntimeError("injected task failure")
        return v

    schema = "k long, ts timestamp_ntz, v string, date date"
    D = dt.datetime
    base = [(i, D(2024, 1, 1 + i % 3), f"b{i}", dt.date(2024, 1, 1 + i % 3)) for i in range(30)]
    batch = [(i, D(2024, 1, 5), f"n{i}", dt.date(2024, 1, 5)) for i in range(20, 40)]
    upsert_table(spark.createDataFrame(base, schema), "flaky_t", ["k"], "ts",
                 partition_cols=["date"])
    src = spark.createDataFrame(batch, schema).repartition(4).withColumn("v", flaky("v"))
    r = upsert_table(src, "flaky_t", ["k"], "ts", partition_cols=["date"])
    rows = {x.k: x.v for x in spark.table("flaky_t").collect()}
    assert len(rows) == 40 and spark.table("flaky_t").count() == 40, len(rows)
    assert all(rows[i] == f"n{i}" for i in range(20, 40)) and rows[0] == "b0"
    assert (r.inserted, r.updated, r.source_rows) == (10, 10, 20), r
    print("RETRY-OK")
""")


def test_failed_task_is_retried_and_load_is_exact(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "flaky.py"
    script.write_text(SCRIPT)
    out = subprocess.run([sys.executable, str(script), repo, str(tmp_path / "ckpt")],
                         capture_output=True, text=True, timeout=600)
    assert "RETRY-OK" in out.stdout, out.stdout[-2000:] + out.stderr[-3000:]
    assert (tmp_path / "ckpt-failed-once").exists()
