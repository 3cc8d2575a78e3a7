"""functions of the glossa corpus engine."""
