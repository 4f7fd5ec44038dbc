"""DataFrame operators, each `DataFrame -> DataFrame`."""
