"""shelfmark: from noisy extracted evidence to one validated price table, on Spark."""
