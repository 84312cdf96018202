"""relcast.operators."""
