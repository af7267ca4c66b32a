"""The batch jobs: lint, shape, SQL load and derived tables."""
