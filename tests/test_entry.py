"""The entry module with parts of the library missing, each tried in a process of its own."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]

HIDE = """
import importlib.abc, sys
class Hidden(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as e
assert set(e.oracle_sql()) <= set(e.queries())
print(sum(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in e.queries()), len(e.queries()))
"""


def names_without(name):
    code = HIDE.format(name=name)
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    if done.returncode:
        raise RuntimeError(done.stderr)
    optional, total = map(int, done.stdout.split())
    return optional, total - optional


@pytest.mark.parametrize("name", ["tidemark.llm", "ahocorasick", "numpy"])
def test_the_rest_works_without_the_subpackage_or_its_packages(name):
    optional, rest = names_without(name)
    assert optional == 0 and rest > 50


def test_a_broken_library_is_not_hidden():
    with pytest.raises(RuntimeError, match="tidemark.operators"):
        names_without("tidemark.operators")
