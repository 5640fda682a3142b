"""End-to-end load plans."""
