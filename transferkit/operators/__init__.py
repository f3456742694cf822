"""DataFrame operators of a transfer."""
