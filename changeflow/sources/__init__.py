"""Sources, sinks and derived inputs."""
