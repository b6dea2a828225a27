"""The entry with and without the training-data package and the pipeline."""

import importlib
import sys
from importlib.abc import MetaPathFinder

import pytest

import __spark_entry__ as entry
from skylens import oracle, registry


class Hidden(MetaPathFinder):
    def __init__(self, *names):
        self.names = names

    def find_spec(self, name, path=None, target=None):
        if any(name == n or name.startswith(n + ".") for n in self.names):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)


@pytest.fixture
def hide(monkeypatch):
    def without(*names):
        for module in [m for m in sys.modules if m == "corpus_pipeline" or m == "skylens.llm" or m.startswith("skylens.llm.") or m in names]:
            monkeypatch.delitem(sys.modules, module)
        monkeypatch.setattr(sys, "meta_path", [Hidden(*names), *sys.meta_path])
        import skylens
        monkeypatch.delattr(skylens, "llm", raising=False)
    return without


@pytest.mark.parametrize("missing", [("skylens.llm",), ("skylens.llm", "corpus_pipeline"), ("skylens.llm.common",)])
def test_core_queries_stay_without_the_package(hide, missing):
    hide(*missing)
    extra = {n for n in entry.queries() if n.startswith("op") or n == "pipeline"}
    assert set(registry.queries()) <= set(entry.queries()) and set(oracle.oracle_sql()) <= set(entry.oracle_sql())
    assert extra == set() or "skylens.llm" not in missing


def test_every_core_query_has_its_sql():
    assert set(registry.queries()) == set(oracle.oracle_sql())


def test_other_missing_modules_are_errors(hide):
    hide("numpy_that_is_missing")
    with pytest.raises(ModuleNotFoundError):
        entry._optional("tests.no_such_folder.module")


def test_nothing_in_the_library_imports_the_package():
    import pathlib
    root = pathlib.Path(entry.__file__).parent / "skylens"
    users = [p for p in root.rglob("*.py") if "llm" not in p.parts and "skylens.llm" in p.read_text()]
    assert users == []
    assert importlib.import_module("skylens.registry")
