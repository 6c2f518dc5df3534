"""DataFrame operators. Each takes and returns DataFrames and stays lazy,
except for the bounded look at heavy keys in :mod:`.heavy`."""
