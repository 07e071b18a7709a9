"""Following a bronze folder that files are added to."""
