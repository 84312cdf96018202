"""relcast.sources."""
