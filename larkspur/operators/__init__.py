"""DataFrame -> DataFrame operators for the four job families."""
