"""Whole jobs: Bronze to Silver, Silver to Gold, and the gated run of both."""
