"""Whole jobs: from files (jobs) and from the contract tables (contract)."""
