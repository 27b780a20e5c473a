"""riskline.plans."""
