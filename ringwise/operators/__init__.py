"""Graph algorithms and ranks as DataFrame jobs."""
