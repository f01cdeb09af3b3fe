"""paneltide: indicator-panel analytics expressed as Spark DataFrame plans.

Every transformation is a lazily composed ``DataFrame -> DataFrame`` function;
nothing is collected to the driver and no Python UDF runs in a hot path.
"""

__version__ = "0.1.0"
