"""DataFrame operators: quality, validation, features, detectors, gold, monitoring."""
