"""Station-status analytics for networks of public service points, on Spark."""
