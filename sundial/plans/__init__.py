"""Feature families: complete jobs composed of the operators."""
