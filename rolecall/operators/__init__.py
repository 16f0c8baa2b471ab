"""DataFrame operators. They build plans; only gates and sinks start jobs."""
