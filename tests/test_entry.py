"""The entry points load without the operators for training data and what these need."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as entry
names = set(entry.queries())
assert "top_terms" in names and len(names) > 70 and set(entry.oracle_sql()) <= names
assert not any(name.startswith("op") or name == "pipeline" for name in names)
"""


@pytest.mark.parametrize("name", ["corpus_pipeline", "gleaner.llm", "ahocorasick", "tokenizers", "xxhash", "numpy"])
def test_queries_without(name):
    done = subprocess.run(
        [sys.executable, "-c", CODE.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr[-2000:]
