"""The entry module where the operators for training data are missing."""

import importlib.util
import os
import sys

import pytest

from tenderlens.catalog import QUERIES

PATH = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")


@pytest.mark.parametrize("hidden", ["tenderlens.llm", "public_tokenizers"])
def test_without_training_data(monkeypatch, hidden):
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("tenderlens.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, hidden, None)  # importing it now raises ImportError
    spec = importlib.util.spec_from_file_location("entry_alone", PATH)
    entry = importlib.util.module_from_spec(spec)
    with pytest.warns(UserWarning, match="left out"):
        spec.loader.exec_module(entry)
    assert set(entry.queries()) == set(QUERIES) == set(entry.oracle_sql())
