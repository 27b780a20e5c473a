"""riskline.functions."""
