"""Report jobs: compositions of the operators over the logical tables."""
