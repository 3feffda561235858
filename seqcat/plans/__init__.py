"""Composed plans: frames -> sequences (A), catalogue -> enriched split sequences (B),
annotation documents -> labels on sequences (C), and the registered table queries."""
