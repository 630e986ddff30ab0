"""llm of leafquarry."""
