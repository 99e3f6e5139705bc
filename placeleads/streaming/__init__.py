"""Leads as a stream."""
