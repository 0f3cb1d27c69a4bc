"""A Spark-native engine for forecast calibration and verification."""
