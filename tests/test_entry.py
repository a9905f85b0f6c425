"""The entry loads without Spark's jars, without a session and without the optional subpackage."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent

PROBE = """
import sys, types
import pyspark
pyspark.__file__ = "/nowhere/pyspark/__init__.py"
{blocked}
import __spark_entry__ as e
assert set(e.oracle_sql()) <= set(e.queries())
print(len(e.queries()), len(e.oracle_sql()))
from pyspark.sql import SparkSession
assert SparkSession.getActiveSession() is None
"""

BLOCK = """
class Block:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("quipu.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Block())
"""


def probe(blocked: str) -> list[int]:
    env = os.environ | {"PYTHONPATH": str(REPO), "SPARK_HOME": "/nowhere", "JAVA_HOME": "/nowhere"}
    code = PROBE.format(blocked=blocked)
    out = subprocess.run([sys.executable, "-c", code], cwd=REPO, env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return [int(x) for x in out.stdout.split()[-2:]]


def test_entry_needs_no_jars_and_no_session():
    n_queries, n_sql = probe("")
    assert n_queries >= 114 and n_sql >= 98


def test_entry_without_the_optional_subpackage():
    n_queries, n_sql = probe(BLOCK)
    assert n_queries >= 114 and n_sql >= 98
