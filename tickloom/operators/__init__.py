"""DataFrame -> DataFrame transformations.

Scale rule used throughout: a *treated series* holds one row per (symbol, date), so a
per-symbol window sees at most one row per calendar day, however hot the symbol is.
Anything that still works on raw rows uses partial aggregates, or the split scan in
``neighbours`` where row order matters.
"""
