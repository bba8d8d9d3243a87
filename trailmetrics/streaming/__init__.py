"""The ad-click stream."""
