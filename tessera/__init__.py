"""tessera: a small PySpark-native library of table and stream operators.

Everything is expressed with DataFrames, Spark SQL and Structured
Streaming so that Catalyst plans it and the data stays distributed.
"""

from tessera.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
