"""sources of the glossa corpus engine."""
