"""Column functions: native expressions only, usable on batch and stream alike."""
