"""Ready-made compositions of the operators."""
