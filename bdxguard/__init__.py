"""bdxguard: set-based bordereau validation and reconciliation on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built on the public
PySpark API.  Files are never looped over on the driver: all files of a run
live in one frame keyed by ``file_hash`` and every rule is evaluated in one
pass, with all check counts produced by one aggregate.
"""

__version__ = "0.1.0"
