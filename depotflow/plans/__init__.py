"""Composite data products: declared checks, publishing, the gated run, and test inputs."""
