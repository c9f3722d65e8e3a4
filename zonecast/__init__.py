"""zonecast: hourly demand analytics by area, written as PySpark DataFrame plans.

Sub-packages
------------
sources     readers and writers (CSV, JSON landing zone, GeoJSON polygons, run tables)
functions   column expressions (calendar parts, names, slugs, geometry predicates)
operators   DataFrame -> DataFrame building blocks (cleaning, spatial join, features,
            splits, scaling, metrics, models, blending, EDA statistics)
plans       whole jobs composed from operators (feature job, sequence job, forecast
            table, the stand-in inputs and the registered query catalogue)
streaming   Structured Streaming version of the hourly count
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value in task closures (grouped-map solves),
    so executors need not have the package installed or on their path."""
    try:
        import sys

        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle: rely on the worker path
        pass


_ship_by_value()
