"""DataFrame-to-DataFrame operators, configured by column names."""
