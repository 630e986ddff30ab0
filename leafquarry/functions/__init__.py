"""functions of leafquarry."""
