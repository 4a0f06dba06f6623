"""Composed plans: the query registry, oracle SQL texts and multi-output jobs."""
