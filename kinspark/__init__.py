"""Spark-first record linkage, with a subpackage ``llm`` for training-data work that nothing else here imports."""
