"""Hierarchies of taxa on Spark; operators for training data in the subpackage llm."""
