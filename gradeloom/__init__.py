"""gradeloom: a PySpark-native engine to prepare, grade, audit and sample evaluation and training data."""
