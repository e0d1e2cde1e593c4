"""The dataflows: extraction, validation, staging, intermediate and mart tables."""
