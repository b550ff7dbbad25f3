"""Column functions: times, labels, ratios and option symbols."""
