"""The entry module with and without the optional package."""

import subprocess
import sys

from conftest import ROOT

BLOCKED = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r} or name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Block())
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from scoreloom.plans.catalog import CATALOG
assert entry.queries().keys() >= CATALOG.keys()
assert {name!r} == "nothing" or not any(q.startswith("op") or q == "pipeline" for q in entry.queries())
"""


def test_entry_survives_what_is_missing():
    for name in ("public_tokenizers", "scoreloom.llm", "nothing"):
        subprocess.run([sys.executable, "-c", BLOCKED.format(name=name, root=str(ROOT))], check=True, timeout=120)
