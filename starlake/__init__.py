"""Starlake: a PySpark-native retail star schema, semantic metrics layer and
integrity-check library. Every operator is a plain ``DataFrame -> DataFrame``
(or ``Column -> Column``) function; the caller owns the ``SparkSession``.
"""

__version__ = "0.1.0"
