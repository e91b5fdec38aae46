"""DataFrame-to-DataFrame operators: cleaning, star build, checks, ranking."""
