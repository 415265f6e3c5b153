"""Whole jobs: transaction rules, message classification, topic model, reports."""
