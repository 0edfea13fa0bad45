"""Training-run planning."""
