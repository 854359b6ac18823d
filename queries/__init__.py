"""Registered queries over the provided tables, each with its SQL check where SQL can say it."""
