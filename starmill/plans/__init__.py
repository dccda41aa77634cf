"""Whole jobs: cleaning, analyses, keywords, chart feeds, the model and the pipeline."""
