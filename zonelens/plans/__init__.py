"""End-to-end analyses composed from operators, and the registry of checked queries."""
