"""Dimensions, facts, marts, and the jobs that bind operators to the entity views."""
