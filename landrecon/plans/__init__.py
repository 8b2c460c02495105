"""Domain steps composed from the operators."""
