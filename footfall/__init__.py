"""Screen-advertising exposure analytics as composable PySpark operators."""
