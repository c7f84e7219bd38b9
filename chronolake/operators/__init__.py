"""DataFrame -> DataFrame operators: layers, keep-first dedupe, comparisons, top-k."""
