"""Analytics workloads as reusable PySpark DataFrame operators."""
