"""The entry module without the optional part."""

import os
import subprocess
import sys
import textwrap

from farebox.registry import QUERIES
from tests.conftest import ROOT

HIDE = """
import sys

class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()))
"""


def keys_without(*names):
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(HIDE).format(names=set(names))], cwd=ROOT, text=True,
                          capture_output=True, env={**os.environ, "PYTHONPATH": ROOT}, check=True)
    return done.stdout.split(), done.stderr


def test_core_keys_stay_without_the_optional_part():
    for hidden in (["farebox.llm"], ["corpus_pipeline"], ["zstandard"], ["public_tokenizers"], ["tokenizers"]):
        (n, sql), said = keys_without(*hidden)
        assert int(n) == len(QUERIES) and int(sql) <= int(n), hidden
        assert "training-data operators are left out" in said
