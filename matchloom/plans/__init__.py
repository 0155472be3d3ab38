"""Named jobs, composed of operators."""
