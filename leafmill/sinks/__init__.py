"""Writers and run-versioned tables."""
