"""Whole plans: a cycle's queue, training steps, and the registered queries."""
