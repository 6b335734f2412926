"""dishframe: Spark DataFrame operators for menu, point-of-interest, page and rater tables."""
