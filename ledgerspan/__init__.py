"""Contract, supplier and spend analytics as PySpark DataFrame operators."""
