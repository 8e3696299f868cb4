"""Queries whose workers need the operators' classes, run from a folder that doesn't hold the package."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CODE = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__
from epistand.session import build_session
spark = build_session(master="local[4]", app="away")
for name in ("op4_mixing", "op6_lm_score", "op7_language_id", "op9_toxicity", "op10_sentencepiece", "op11_token_files", "op12_spelling",
             "op13_conversations"):
    print(name, __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_queries_run_without_the_package_on_the_path():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory(prefix="epistand-away-", dir="/tmp") as folder:
        done = subprocess.run([sys.executable, "-c", CODE.format(repo=REPO)], cwd=folder, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    counts = dict(line.split() for line in done.stdout.splitlines() if line.startswith("op"))
    assert len(counts) == 8 and all(int(n) > 0 for n in counts.values())
