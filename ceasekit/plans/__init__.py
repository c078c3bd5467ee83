"""Composite jobs: data quality, observation set, features, profiles, model."""
