"""DataFrame-to-DataFrame steps. All of them are lazy."""
