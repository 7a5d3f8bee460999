"""Helpers that keep plans safe at scale: settled intermediates and distributed numbering."""
