"""The entry point with and without the optional corpus folder and its libraries."""

import importlib
import subprocess
import sys
from pathlib import Path

import pytest

from tidemark.plans.registry import all_queries

TOP = Path(__file__).resolve().parents[1]

HIDE = """
import importlib.abc, sys

class Hidden(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if any(name == h or name.startswith(h + ".") for h in {hidden!r}):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Hidden())
sys.path.insert(0, {top!r})
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), callable(entry.entry))
"""


@pytest.mark.parametrize("hidden", [["tidemark.llm", "corpus_pipeline"], ["tidemark.llm"], ["public_tokenizers"]])
def test_without_corpus(hidden):
    code = HIDE.format(hidden=hidden, top=str(TOP))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, check=True).stdout.split()
    with_sql = sum(q.sql is not None for q in all_queries().values())
    assert out == [str(len(all_queries())), str(with_sql), "True"]


def test_without_a_library_of_some_queries():
    code = HIDE.format(hidden=["tokenizers", "sentencepiece"], top=str(TOP))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, check=True).stdout.split()
    assert int(out[0]) >= len(all_queries())


def test_contract():
    entry = importlib.import_module("__spark_entry__")
    assert set(all_queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
