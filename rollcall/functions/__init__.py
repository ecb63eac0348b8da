"""Column functions: text, dates, hour quantities and code labels."""
