"""The pipeline on a small cluster whose executors are replaced between and during its stages."""

import os
import subprocess
import sys
from pathlib import Path

import pyspark

REPO = Path(__file__).resolve().parents[2]

RUN = """
import os, signal, sys, time
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
import corpus_pipeline
from lumengrid.llm.common import clear, made, saved, table

work = sys.argv[1]
spark = (SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.checkpoint.dir", f"file://{{work}}/shared").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
    .config("spark.driver.host", "127.0.0.1").config("spark.deploy.maxExecutorRetries", "-1").config("spark.sql.warehouse.dir", f"{{work}}/warehouse").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")

def executors():
    # processes of this session: their class path names its own home
    out = set()
    for pid in filter(str.isdigit, os.listdir("/proc")):
        try:
            with open(f"/proc/{{pid}}/cmdline", "rb") as f:
                told = f.read().decode(errors="replace")
        except OSError:
            continue
        if "CoarseGrainedExecutorBackend" in told and os.environ["SPARK_HOME"] in told:
            out.add(int(pid))
    return out

def replaced(all_of_them=True):
    old = executors()
    for pid in sorted(old) if all_of_them else sorted(old)[:1]:
        os.kill(pid, signal.SIGKILL)
    for _ in range(300):
        if len(executors() - old) >= (len(old) if all_of_them else 1):
            return
        time.sleep(0.2)
    raise SystemExit("no new executor")

docs = table(spark, {folder!r}, "documents")
plain = {{r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, {folder!r}).collect()}}
since = made()
for name, stage in corpus_pipeline.STAGES:
    if name in ("decontamination", "bpe"):
        replaced()
    df = stage(spark, docs, {folder!r})
    if name in ("near_dedup", "bpe"):
        replaced(False)  # what the stage has planned and written is read by an executor that wasn't there
    docs = saved(df, f"pipeline-{{name}}")
    clear(spark, since, made() - 1)
got = {{r.doc_id: (r.n_tokens, r.ids_sha256) for r in docs.collect()}}
assert plain and got == plain, (len(got), len(plain))
print("same rows:", len(got))
"""


def test_pipeline_with_replaced_executors(tmp_path):
    home = tmp_path / "home"
    home.mkdir()
    for p in Path(pyspark.__file__).parent.iterdir():  # executors write their logs below Spark's home
        if p.name != "work":
            (home / p.name).symlink_to(p)
    env = {**os.environ, "SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_LOCAL_DIRS": str(tmp_path / "local"), "PYTHONPATH": str(REPO), "PYSPARK_PYTHON": sys.executable}
    run = subprocess.run([sys.executable, "-c", RUN.format(repo=str(REPO), folder="/root/testdata/sf0.001"), str(tmp_path)], cwd=REPO, env=env, capture_output=True, text=True, timeout=900)
    assert run.returncode == 0 and "same rows:" in run.stdout, run.stdout[-500:] + run.stderr[-4000:]
