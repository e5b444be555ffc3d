"""Column-level building blocks: text analysis, stemming, similarity."""
