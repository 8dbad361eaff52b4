"""Part of geoquilt: operators."""
