"""Tests of the operators that prepare training data."""
