"""Plans: the end-to-end job, fixtures over the driver tables and the query registry."""
