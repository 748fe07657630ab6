"""Part of presslake."""
