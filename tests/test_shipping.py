"""Functions of the package travel with jobs by value, with all they refer to."""

import os
import subprocess
import sys

#: In an interpreter of its own: functions of Spark that were used in a session hold on to it.
SCRIPT = """
import importlib, inspect, pkgutil
from pyspark import cloudpickle
import fraclake

for m in pkgutil.walk_packages(fraclake.__path__, "fraclake."):
    if m.ispkg or m.name.startswith("fraclake.llm"):
        continue
    for one in vars(importlib.import_module(m.name)).values():
        if (inspect.isfunction(one) or inspect.isclass(one)) and one.__module__ == m.name:
            assert cloudpickle.dumps(one)
print("sent")
"""


def test_all_functions_can_be_sent_to_tasks():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "sent", done.stderr[-2000:]
