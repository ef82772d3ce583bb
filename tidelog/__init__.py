"""tidelog: change-log analytics on PySpark.

Binary logs of MySQL- and MariaDB-style servers become Spark tables and
streams; everything after that is joins, windows, aggregates and state.
"""
