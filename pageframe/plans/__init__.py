"""Page planning: index plans, next-URL rules, chains, and whole reads."""
