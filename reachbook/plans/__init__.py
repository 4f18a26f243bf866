"""The datasets and reports, each a function from a Campaign to a DataFrame."""
