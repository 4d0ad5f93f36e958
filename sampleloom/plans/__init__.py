"""Registered queries: canonical tables bound to the test tables, and one plan per operator."""
