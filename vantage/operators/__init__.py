"""DataFrame operators grouped by family (see README for the inventory)."""
