"""Plans: the whole pipeline (batch and stream) and the registered queries with their SQL oracles."""
