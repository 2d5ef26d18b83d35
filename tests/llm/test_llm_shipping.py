"""Functions of this package travel with jobs by value, with all they refer to."""

import importlib
import inspect
import pkgutil

import pytest
from pyspark import cloudpickle

import fraclake.llm


@pytest.mark.parametrize("name", sorted(m.name for m in pkgutil.iter_modules(fraclake.llm.__path__)))
def test_all_functions_can_be_sent_to_tasks(name):
    module = importlib.import_module(f"fraclake.llm.{name}")
    for one in vars(module).values():
        if (inspect.isfunction(one) or inspect.isclass(one)) and one.__module__ == module.__name__:
            assert cloudpickle.dumps(one)
