"""Models, rollups, the warehouse, the monthly run and the served queries."""
