"""Readers: files, text lines, adjacency lists, streams and contract tables."""
