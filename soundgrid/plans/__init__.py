"""Plans that chain operators into products."""
