"""sources of leafquarry."""
