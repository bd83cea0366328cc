"""DataFrame-to-DataFrame transforms. None of them runs an action."""
