"""Reading, landing and exporting tables; derived study tables for tests."""
