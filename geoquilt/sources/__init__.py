"""Part of geoquilt: sources."""
