"""The package works on executors that do not have it."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from folioscope.session import local_session
import __spark_entry__ as driver
spark = local_session(2, 2)
for name in ("embed_hash", "precision_at_k", "similar_pages"):
    print(name, driver.queries()[name](spark, {folder!r}).count())
"""


def test_python_workers_need_no_copy_of_the_package(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = SCRIPT.format(root=root, folder="/root/testdata/sf0.001")
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert "similar_pages 1500" in done.stdout
