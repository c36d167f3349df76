"""Part of the point-in-time analytics library."""
