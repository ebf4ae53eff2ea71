"""Operators run where executors have no copy of the package."""

import os
import subprocess
import sys
import textwrap

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})  # the driver's path only; workers start without it
from tidemark.session import local_session
spark = local_session(4, shuffle_partitions=4, app="tidemark-bare-workers")

def probe(batches):
    import importlib.util
    import pyarrow as pa
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("tidemark") is not None])], ["found"])

assert not spark.range(1).mapInArrow(probe, "found boolean").first().found, "workers see the package"
import __spark_entry__
for name in {names!r}:
    assert __spark_entry__.queries()[name](spark, {sf!r}).count() > 0, name
    print("ran", name)
"""


@pytest.mark.parametrize("names", [
    ["op1_toxicity", "op2_decontaminate", "op3_substring_dedup", "op4_html_text", "op5_ann", "op9_simhash"],
    ["op8_lm_score", "op10_pack", "op12_collocations", "op13_language_id", "pipeline"]])
def test_workers_without_the_package(names, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = tmp_path / "run.py"
    script.write_text(textwrap.dedent(SCRIPT).format(repo=REPO, names=names, sf="/root/testdata/sf0.001"))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [x.split()[1] for x in done.stdout.splitlines() if x.startswith("ran ")] == names
