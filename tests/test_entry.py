"""The driver's contract, with and without the corpus operators."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["public_tokenizers", "foghorn.llm", "foghorn.llm.queries", "corpus_pipeline"])
def test_queries_without_the_corpus_part(missing):
    code = (
        f"import sys; sys.modules[{missing!r}] = None\n"
        "import __spark_entry__ as e\nfrom foghorn.catalog import QUERIES, ORACLES\n"
        "found, sql = e.queries(), e.oracle_sql()\n"
        "assert set(QUERIES) <= set(found) and set(ORACLES) <= set(sql) <= set(found)\n"
        "assert 'pipeline' not in found\n"
        f"assert any(n.startswith('op') and n[2:3].isdigit() for n in found) == ({missing!r} == 'corpus_pipeline')\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
