"""End-to-end refresh, the registered query catalogue and its SQL oracles."""
