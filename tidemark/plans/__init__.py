"""User-level jobs composed from the operators."""
