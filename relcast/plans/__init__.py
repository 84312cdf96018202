"""relcast.plans."""
