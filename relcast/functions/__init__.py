"""relcast.functions."""
