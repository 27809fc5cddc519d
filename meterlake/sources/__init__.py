"""Readers for raw trip files and the zone list, and the tables of the lake."""
