"""riskline.sources."""
