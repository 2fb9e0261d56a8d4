"""The entry point without what the operators for training data need."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("blocked", ["public_tokenizers", "daymark.llm", "corpus_pipeline"])
def test_entry_imports_without(blocked):
    """What cannot be imported takes its own queries away and no others."""
    code = (f"import sys; sys.modules[{blocked!r}] = None; import __spark_entry__ as e; names = set(e.queries()); "
            "assert 'monthly_climate' in names and 'pipeline' not in names; assert set(e.oracle_sql()) <= names; "
            f"assert any(n.startswith('op') and n[2].isdigit() for n in names) is ({blocked!r} == 'corpus_pipeline' "
            "and __import__('importlib.util').util.find_spec('daymark.llm') is not None)")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
