"""riskline.operators."""
