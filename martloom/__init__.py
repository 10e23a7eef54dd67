"""martloom: table pipelines for retail-style data, written as PySpark DataFrame operators."""
