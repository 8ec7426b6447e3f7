"""Column expressions: time arithmetic, classification, and the fixed value lists they use."""
