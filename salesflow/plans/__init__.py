"""Ready-made jobs, and the registered queries with their oracle SQL."""
