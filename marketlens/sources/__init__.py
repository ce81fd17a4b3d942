"""Reading source datasets and writing results."""
