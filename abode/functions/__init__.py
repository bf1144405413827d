"""Column -> Column helpers: text, dates, numbers, rule tables."""
