"""DataFrame-to-DataFrame operators, usable on batch data and, where noted, on streams."""
