"""Readers and writers: landing files, the versioned history, the seed of points."""
