"""Whole experiments composed from the operators, each one lazy DataFrame plan."""
