"""operators of leafquarry."""
