"""Sales-compensation analytics as reusable PySpark DataFrame operators."""
