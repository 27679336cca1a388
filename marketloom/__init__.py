"""marketloom: a Spark-native engine for market-data pipelines and time-series analytics."""
