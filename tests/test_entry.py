"""The driver contract with and without what the training-data queries need."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(block: str = "") -> set[str]:
    code = f"""
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in {block.split()!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Gone())
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as E
assert set(E.oracle_sql()) <= set(E.queries())
print(" ".join(sorted(E.queries())))
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    return set(done.stdout.split())


def test_core_queries_need_none_of_it():
    from haltgate.plans import catalog

    core = set(catalog.queries())
    for missing in ("public_tokenizers", "xxhash", "haltgate.llm", "corpus_pipeline"):
        assert names(missing) == core
    assert names() >= core
