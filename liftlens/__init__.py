"""Treatment-effect analytics as PySpark DataFrame operators."""
