"""Operators for large-scale training-data pipelines. Nothing else in chatloom imports this."""
