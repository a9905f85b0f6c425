"""Recommendation and learner analytics as DataFrame-to-DataFrame functions on Spark."""
