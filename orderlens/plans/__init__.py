"""Plans: the facts frame, the query catalog, the refresh job, oracle SQL."""
