"""Column-level building blocks: text, labels, scorers."""
