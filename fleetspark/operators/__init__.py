"""Cleaning, standardising, enrichment, star schema and the four analytics layers."""
