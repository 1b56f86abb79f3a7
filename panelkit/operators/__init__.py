"""DataFrame operators: keys, monthly rollups, panel, encoding, split, evaluation."""
