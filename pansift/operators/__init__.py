"""DataFrame -> DataFrame operators, grouped as in the blueprint."""
