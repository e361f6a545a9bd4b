"""Reports: functions from the table catalogue to a DataFrame."""
