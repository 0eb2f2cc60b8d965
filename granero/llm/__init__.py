"""Operators for training-data work over the programme's free text, series and conversations."""
