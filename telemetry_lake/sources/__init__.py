"""Batch scans."""
