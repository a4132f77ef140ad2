"""Jobs: operators bound to inputs and outputs."""
