"""Whole plans: from observations to segments, features, journeys and comparisons."""
