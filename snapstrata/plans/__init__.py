"""Jobs: operators composed between a source and a sink."""
