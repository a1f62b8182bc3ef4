"""Shipped rule documents."""
