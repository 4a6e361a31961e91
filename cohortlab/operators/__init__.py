"""DataFrame-to-DataFrame operators: series, reshape, text, persona,
regression and experiment statistics."""
