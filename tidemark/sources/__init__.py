"""Reading and writing tables and event files."""
