"""tessera — table analytics as lazy Spark DataFrame operators.

Every public operator is a plain function ``DataFrame (+ options) -> DataFrame``
built on Spark SQL / ``spark.ml`` built-ins, so Catalyst plans it and it composes
with ``DataFrame.transform``.
"""

__version__ = "0.1.0"
