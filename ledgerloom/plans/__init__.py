"""Query plans: insight reports, the layered pipeline and the query catalog."""
