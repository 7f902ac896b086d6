"""End-to-end plans, the clinical-shaped views over the given tables, and the query catalog."""
