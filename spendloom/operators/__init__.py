"""Operations on whole DataFrames: reshape, filter, join, reject, merge."""
