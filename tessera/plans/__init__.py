"""From a request to a checked plan."""
