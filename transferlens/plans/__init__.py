"""Named analytics. ``t`` is one chain's transfers, ``m`` the same chain's token metadata.

Thresholds, windows, limits and ``as_of`` are keyword parameters. Every limited result breaks ties on a
unique column, so it is repeatable. ``limit=None`` returns the whole result.
"""
