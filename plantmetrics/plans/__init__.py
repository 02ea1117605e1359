"""Named data jobs composed of the operators."""
