"""Table operators, feature building and MLlib training for linked match data."""
