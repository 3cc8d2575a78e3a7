"""streaming of the glossa corpus engine."""
