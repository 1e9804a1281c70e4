"""tidewatch: event-history and workforce analytics as plain PySpark DataFrame operators."""
