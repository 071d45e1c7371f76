"""Whole jobs: rechunk files, build a store, publish it."""
