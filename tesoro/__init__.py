"""tesoro: treasury and collateral analytics on Spark."""


def _ship_by_value() -> None:
    """Python code that runs on executors (the ledger kernel of
    ``mapInPandas``) is pickled by value, so workers need neither this
    package installed nor the driver's working directory on their path."""
    try:
        import sys

        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older cloudpickle: fall back to by-reference
        pass


_ship_by_value()
