"""Named queries over the driver tables (one module per operator family)."""

from __future__ import annotations

import importlib

_MODULES = ["features", "analysis", "modelling"]


def _load():
    for m in _MODULES:
        importlib.import_module(f"fieldstat.plans.{m}")


def all_queries():
    from fieldstat.plans.registry import QUERIES
    from fieldstat.session import ensure_checkpoint_dir
    _load()

    def wrap(fn):
        def run(spark, sf_dir):
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    return {k: wrap(v) for k, v in QUERIES.items()}


def all_oracles():
    from fieldstat.plans.registry import ORACLE
    _load()
    return dict(ORACLE)
