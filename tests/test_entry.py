"""The entry point without parts of what it may offer."""

import os
import subprocess
import sys

import pytest
from conftest import ROOT

CODE = """
import sys
sys.path.insert(0, {root!r})
sys.modules[{hidden!r}] = None  # importing it fails
import __spark_entry__ as entry
names = set(entry.queries())
assert "D1_first_seen" in names and len(names) > 140 and set(entry.oracle_sql()) <= names
print("names", sum(n.startswith("op") for n in names))
"""


@pytest.mark.parametrize("hidden", ["tiktoken", "xxhash", "sentencepiece", "public_tokenizers", "corpus_pipeline", "wagelens.llm", "wagelens.llm.queries"])
def test_other_queries_stay(hidden):
    done = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT, hidden=hidden)], capture_output=True, text=True, timeout=100, env=dict(os.environ))
    assert "names" in done.stdout, done.stderr[-2000:]
    assert "left out" in done.stderr
