"""Part of geoquilt: functions."""
