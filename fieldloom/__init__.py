"""fieldloom: a Spark-native engine that plans, samples and prepares data."""
