"""countloom: a Spark-native analytics engine for barcoded, count-based measurement data."""
