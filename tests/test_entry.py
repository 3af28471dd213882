"""The registered queries without what the text operators need."""

import subprocess
import sys

import pytest

import __spark_entry__ as E
from reachlens.plans import QUERIES
from tests.conftest import ROOT


@pytest.mark.parametrize("blocked", ["xxhash", "zstandard", "reachlens.llm", "corpus_pipeline"])
def test_a_missing_package_costs_no_other_query(blocked):
    code = f"""import sys
sys.modules[{blocked!r}] = None
import __spark_entry__ as E
print(len([n for n in E.queries() if not n.startswith("op") and n != "pipeline"]), len(E.oracle_sql()))"""
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) == len(QUERIES) and int(out[1]) > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
