"""chatloom: a Spark-native engine that curates conversational training corpora."""
