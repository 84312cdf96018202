"""relcast.streaming."""
