"""PySpark-native analytics over device-telemetry and service-desk data lakes."""
