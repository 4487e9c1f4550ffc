"""Whole workflows: preparation, tree studies and dense models."""
