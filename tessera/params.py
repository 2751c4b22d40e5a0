"""Parameters of a stage, checked before any work starts."""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame


class ParameterError(ValueError):
    """A stage was given parameters that it does not take, or lacks one."""


def allowed(stage: Callable) -> dict[str, bool]:
    """The parameters of ``stage`` that are no table, and whether each must be given."""
    named = inspect.signature(stage, eval_str=True).parameters.values()
    return {p.name: p.default is p.empty for p in named if p.annotation is not DataFrame and p.annotation != DataFrame | None}


def check(stage: Callable, given: dict) -> None:
    """Raise ``ParameterError`` that names every unknown and every missing parameter."""
    table = allowed(stage)
    wrong = [f"unknown {k}" for k in sorted(given.keys() - table.keys())]
    wrong += [f"missing {k}" for k, must in table.items() if must and k not in given]
    if wrong:
        raise ParameterError(f"{stage.__name__}: " + ", ".join(wrong))


def run(stage: Callable, *tables: DataFrame, **given):
    """``stage`` over ``tables`` with checked parameters."""
    check(stage, given)
    return stage(*tables, **given)
