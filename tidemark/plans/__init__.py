"""Scoring-side plans: feature selection, model,
explanations, business rule and report shaping."""
