"""Part of geoquilt: streaming."""
