"""Independent SQL for checking the reports."""
