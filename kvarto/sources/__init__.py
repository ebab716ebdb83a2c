"""Readers of the tables and files the engine works on."""
