"""Vehicle-listing analytics as plain DataFrame transforms on Spark."""
