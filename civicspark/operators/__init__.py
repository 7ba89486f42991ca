"""DataFrame -> DataFrame operators of the three feeds and their models."""
