"""Dataset plans (silver, gold, star) and the registered queries."""
