"""The entry points work without the optional modules."""

import subprocess
import sys

CODE = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("dishframe.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
names = set(entry.queries())
assert len(names) > 100 and not any(n.startswith("op") and n[2].isdigit() for n in names) and "pipeline" not in names
assert set(entry.oracle_sql()) <= names
"""


def test_entry_without_optional_modules():
    subprocess.run([sys.executable, "-c", CODE], check=True)
