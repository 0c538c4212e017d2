"""Registered queries over the driver tables, each with its SQL counterpart."""


def load() -> None:
    """Import every module that registers queries."""
    from importlib import import_module

    for name in MODULES:
        import_module(f"catalog.{name}")


MODULES = ("evidence", "timeseries", "reports", "extraction", "routing")
