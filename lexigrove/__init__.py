"""lexigrove: a PySpark-native analytics engine for structured documents and graphs."""
