"""Layout rules that the driver's runs depend on."""
import importlib
import os
import sys
from collections import Counter
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_test_module_names_are_unique():
    # Test folders are no packages: two files of one name would not be collected.
    names = Counter(p.name for p in (ROOT / "tests").rglob("test_*.py"))
    assert [n for n, k in names.items() if k > 1] == []


def test_entry_works_without_a_library_of_the_subpackage(monkeypatch):
    """Whatever the optional subpackage fails to import, the lakehouse queries stay."""
    hidden = [m for m in sys.modules if m.startswith("shopfloor.llm") or m in ("corpus_pipeline", "__spark_entry__", "zstandard")]
    for module in hidden:
        monkeypatch.delitem(sys.modules, module)
    monkeypatch.setitem(sys.modules, "zstandard", None)  # "import zstandard" raises ImportError
    monkeypatch.syspath_prepend(os.fspath(ROOT))
    entry = importlib.import_module("__spark_entry__")
    from shopfloor.plans.catalog import QUERIES

    assert set(entry.queries()) == set(QUERIES) == set(entry.oracle_sql())
    monkeypatch.delitem(sys.modules, "__spark_entry__")
