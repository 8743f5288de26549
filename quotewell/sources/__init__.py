"""Reading, landing and laying out tables."""
