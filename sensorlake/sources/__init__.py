"""Readers (S01-S08, S13-S18) and writers."""
