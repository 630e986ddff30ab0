"""streaming of leafquarry."""
