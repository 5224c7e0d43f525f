"""DataFrame operators on panels and vintage tables."""
