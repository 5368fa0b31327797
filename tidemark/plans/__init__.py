"""Business analyses composed from the operators."""
