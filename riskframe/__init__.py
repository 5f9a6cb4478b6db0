"""riskframe: transaction-risk analytics as Spark DataFrame operators.

Every public operator is a plain function ``DataFrame -> DataFrame`` (or a
small helper that returns a ``Column``); nothing is collected to the driver
except bounded summaries (one row per class, per column, per bucket).
"""

__version__ = "0.1.0"
