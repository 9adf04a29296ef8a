"""The contract's module, with and without the corpus subpackage."""

import subprocess
import sys
from pathlib import Path

TOP = Path(__file__).parent.parent
HIDE = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name == "tamiz.llm" or name.startswith("tamiz.llm."):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Hidden())
"""


def run(code):
    return subprocess.run([sys.executable, "-c", code], cwd=TOP, capture_output=True, text=True, timeout=120)


def test_without_the_corpus_operators():
    out = run(HIDE + "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))")
    assert out.returncode == 0, out.stderr
    n, m, corpus = out.stdout.split()
    assert int(n) > 120 and int(m) > 110 and corpus == "False"


def test_every_oracle_has_a_query():
    out = run("import __spark_entry__ as e; print(set(e.oracle_sql()) - set(e.queries()))")
    assert out.returncode == 0 and out.stdout.strip() == "set()", out.stderr
