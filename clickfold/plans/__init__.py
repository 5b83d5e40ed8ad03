"""Plans: feature-table assembly, model fit/score/evaluate, and the query
catalog used by ``__spark_entry__``."""
