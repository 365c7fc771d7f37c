"""What the operators are checked with: input views, registered queries, oracle SQL."""
