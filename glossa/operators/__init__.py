"""operators of the glossa corpus engine."""
