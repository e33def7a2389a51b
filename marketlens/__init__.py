"""marketlens: marketplace seller analytics on Spark.

Every operator is a pure ``DataFrame -> DataFrame`` function built from
Spark SQL expressions. Configuration (date bounds, ``now``, filters) is
passed in as arguments; nothing reads the clock or collects to the driver.
"""

from marketlens.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
