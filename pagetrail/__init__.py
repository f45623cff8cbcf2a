"""Browsing-history analytics on Spark DataFrames."""

from pagetrail.operators import chromium, firefox, safari, saved_tabs, summary
from pagetrail.schemas import CHROMIUM, FIREFOX, SAFARI

__all__ = ["CHROMIUM", "FIREFOX", "SAFARI", "chromium", "firefox", "safari", "saved_tabs", "summary"]
