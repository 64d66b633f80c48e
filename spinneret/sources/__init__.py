"""Page, fetch-log and seed readers, and the index and segment writers."""
