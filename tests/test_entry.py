"""The entry module with and without the optional operators."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
for name in sys.argv[1:]:
    sys.modules[name] = None
import __spark_entry__ as e
names = e.queries()
assert "surviving_events" in names and set(e.oracle_sql()) <= set(names)
print(len([n for n in names if n == "pipeline" or n[:2] == "op" and n[2].isdigit()]))
"""


def counted(*absent: str) -> int:
    run = subprocess.run([sys.executable, "-c", CODE, *absent], cwd=ROOT, capture_output=True, text=True, check=True)
    return int(run.stdout)


def test_queries_without_the_text_operators():
    assert counted("corpus_pipeline") == 0
    assert counted("corpus_pipeline", "duoscope.llm", "duoscope.llm.queries") == 0
    assert counted("duoscope.llm") == 0


def test_queries_without_the_libraries_of_the_text_operators():
    assert counted("public_tokenizers") == 0
