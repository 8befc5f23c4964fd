"""Reading dropped files and writing exports."""
