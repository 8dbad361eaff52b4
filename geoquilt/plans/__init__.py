"""Part of geoquilt: plans."""
