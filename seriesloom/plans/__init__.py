"""Feature configurations and the multi-stage jobs built from operators."""
