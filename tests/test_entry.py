import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
WITHOUT = """
import sys, warnings
sys.path.insert(0, {repo!r})
sys.modules[{module!r}] = None
import __spark_entry__ as entry
with warnings.catch_warnings(record=True) as told:
    warnings.simplefilter("always")
    names, checked = set(entry.queries()), set(entry.oracle_sql())
assert "l1_churn_label" in names and checked < names and len(names) > 100
assert not any(n.startswith("op") for n in names) and told
"""


@pytest.mark.parametrize("module", ["ahocorasick", "public_tokenizers", "tenura.llm", "corpus_pipeline"])
def test_other_queries_stay_without_the_optional_ones(module):
    code = WITHOUT.format(repo=str(REPO), module=module)
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=60)
