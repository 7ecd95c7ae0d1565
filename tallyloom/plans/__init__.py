"""Configured table runs: step chains, table specs and the three data flows."""
