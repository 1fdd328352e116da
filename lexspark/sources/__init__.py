"""Readers of landed inputs."""
