"""Readers, sinks and derived inputs."""
