"""Point-in-time analytics as DataFrame operators."""
