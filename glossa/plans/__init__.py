"""plans of the glossa corpus engine."""
