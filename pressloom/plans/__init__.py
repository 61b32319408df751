"""Named queries (one per operator key) and jobs composed from the operators."""
