"""DataFrame-to-DataFrame operators with no domain constants of their own."""
