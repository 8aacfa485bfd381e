"""The driver contract holds with and without the training-data subpackage."""

import subprocess
import sys

import pytest
from conftest import ROOT

CODE = """
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as e
from kinspark.plans import catalogue
assert set(e.queries()) == set(catalogue.QUERIES) and set(e.oracle_sql()) == set(catalogue.ORACLE_SQL)
"""


@pytest.mark.parametrize("missing", ["public_tokenizers", "kinspark.llm", "corpus_pipeline"])
def test_entry_without_optional_parts(missing):
    """A module that can't be imported takes its queries along and nothing else."""
    done = subprocess.run([sys.executable, "-c", CODE.format(missing=missing)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_every_sql_has_its_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
