"""Column-level helpers and reusable ordered-scan / order-statistic building blocks."""
