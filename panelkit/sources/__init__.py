"""Where data comes from and goes to: raw tables, feature tables, runs, models."""
