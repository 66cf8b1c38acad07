"""Versioned lexical data and corpus analytics, written as plain DataFrame functions."""
