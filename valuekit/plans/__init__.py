"""Domain jobs: configurations of the generic operators."""
