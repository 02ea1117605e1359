"""PySpark operators for plant sensors, production KPIs and predictive maintenance."""
