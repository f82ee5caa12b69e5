"""The layers: cleaned tables, dimensions, fact, mart, key figures and reports."""
