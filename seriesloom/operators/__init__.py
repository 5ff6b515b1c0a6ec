"""DataFrame-to-DataFrame operators over panels."""
