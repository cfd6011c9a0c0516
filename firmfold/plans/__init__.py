"""Jobs: operators strung together over stored tables."""
