"""Every module of the package imports (the reference checks the same of its pipeline modules)."""

import importlib
import pkgutil

import pytest

import strata

MODULES = sorted(m.name for m in pkgutil.walk_packages(strata.__path__, prefix="strata."))


@pytest.mark.parametrize("name", MODULES)
def test_module_imports(name):
    importlib.import_module(name)


def test_package_layout():
    for sub in ("operators", "sources", "functions", "plans", "streaming"):
        assert f"strata.{sub}" in MODULES
