"""The operators run where only the driver has this package."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from martweave.session import local_session
from martweave.llm.queries import QUERIES
import corpus_pipeline
spark = local_session(4, shuffle_partitions=4, name="workers")

def importable(batches):
    import pyarrow as pa
    import importlib.util
    for _ in batches:
        yield pa.RecordBatch.from_pydict({{"found": [importlib.util.find_spec("martweave") is not None]}})

assert not any(r.found for r in spark.range(4).mapInArrow(importable, "found boolean").collect())
for name, query in {{**QUERIES, "pipeline": corpus_pipeline.run}}.items():
    print(name, query(spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=str(ROOT))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900
    )
    assert done.returncode == 0, done.stderr[-3000:]
    counts = dict(line.split() for line in done.stdout.splitlines())
    assert len(counts) == 14 and all(int(n) for n in counts.values())
