"""Functions of the engine; every public callable takes and returns DataFrames."""
