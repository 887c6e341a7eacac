"""DataFrame -> DataFrame operators: unnest, search, history, sequence index, fits."""
