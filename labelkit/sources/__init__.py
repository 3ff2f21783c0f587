"""Readers and writers of example, rater, split, prediction and summary tables."""
