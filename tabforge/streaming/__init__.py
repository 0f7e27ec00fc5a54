"""Stateless scoring of streams."""
