"""End-to-end compositions and the bindings to the driver's tables."""
