"""Readers. Every one of them has an explicit schema; none infers."""
