"""Reading, choosing and writing files."""
