"""Operators that compose DataFrame calls into one reusable step."""
