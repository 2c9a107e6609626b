"""DataFrame operators. Column names are arguments, so they fit any entity/category/value table."""
