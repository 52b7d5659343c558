"""Inputs and outputs: record lines, dimensions, requests, stored tables."""
